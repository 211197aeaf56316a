from hypothesis import given, settings
from hypothesis import strategies as st

from plume.llm import token_counts as tc
from plume.llm.queries import TOKENIZERS, op4_token_counts

SF = "/root/testdata/sf0.001"
PATH = f"{TOKENIZERS}/word_bpe_49k.json"
PIECES = tc.load_vocabulary(PATH)
KNOWN = set(PIECES) | {(b,) for b in range(256)} | {(tc.END,)}
LONGEST = max(map(len, KNOWN))
AUTO = tc.LongestMatch(PIECES)


def _greedy(word: bytes) -> int:
    """Longest match first, building the pieces."""
    symbols, n = (*word, tc.END), 0
    while symbols:
        k = next(k for k in range(min(LONGEST, len(symbols)), 0, -1) if symbols[:k] in KNOWN)
        n += symbols[:k] != (tc.END,)
        symbols = symbols[k:]
    return n


def _count(text):
    words = [w for c in (text or "").split() for w in tc.words_of(c)]
    return sum(map(_greedy, words)), len(words)


@settings(deadline=None)
@given(st.lists(st.text(min_size=1, max_size=40).map(lambda t: t.encode("utf-8", "surrogatepass")), max_size=8))
def test_automaton_against_greedy(words):
    assert AUTO.counts(words).tolist() == [_greedy(w) for w in words]


def test_small_vocabulary_with_long_failures():
    pieces = [tuple(b"abcd"), (*b"abcde", tc.END), tuple(b"bc"), tuple(b"cdx"), (*b"d", tc.END)]
    auto, known = tc.LongestMatch(pieces), set(pieces) | {(b,) for b in range(256)} | {(tc.END,)}

    def greedy(w):
        s, n = (*w, tc.END), 0
        while s:
            k = next(k for k in range(len(s), 0, -1) if s[:k] in known)
            n += s[:k] != (tc.END,)
            s = s[k:]
        return n

    words = [b"abcde", b"abcdx", b"abcd", b"abcabcdeabcd", b"", b"cdxcd"]
    assert auto.counts(words).tolist() == [greedy(w) for w in words]


def test_query_against_brute_force(spark):
    want = {(r["doc_id"], *_count(r["text"])) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {(r["doc_id"], r["n_tokens"], r["n_words"]) for r in op4_token_counts(spark, SF).collect()}
    assert got == want


def test_edge_tables(spark, edge_docs, no_docs, clashing):
    got = sorted((r["n_tokens"], r["n_words"]) for r in tc.token_counts(clashing, PATH).collect())
    assert got == sorted(_count(r["text"]) for r in edge_docs.collect())
    assert tc.token_counts(no_docs, PATH).count() == 0
