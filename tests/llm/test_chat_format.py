import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from plume.llm import chat_format as cf
from plume.llm.queries import op1_chat_format

SF = "/root/testdata/sf0.001"
_TEXT = st.text(alphabet=list("<s>[/INSTROLE]\\ab\n\"é"), max_size=25)


@given(_TEXT)
def test_escape_is_reversible_and_hides_controls(text):
    out = cf.escape(text)
    assert cf.unescape(out) == text
    assert not any(c in out for c in cf._CONTROL)


@settings(deadline=None)
@given(st.lists(st.tuples(_TEXT, _TEXT), max_size=6))
def test_template_reads_back(turns):
    assert cf.read_marked(cf.render_marked(turns)) == turns


@settings(deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant"]), _TEXT), min_size=1, max_size=20))
def test_spans_with_a_moving_window(turns):
    state = cf.Incremental(cf.render_marked, window=5, overlap=2)
    out, whole = "", cf.render_marked(turns)
    for role, text in turns:
        piece, start, end, lo, hi, sound = state.add(role, text)
        assert sound and start == len(out)
        out += piece
        assert end == len(out) and cf.unescape(whole[lo:hi]) == text
    assert out == whole


def test_rewriting_templates_are_detected():
    def last_only(messages):  # drops earlier texts
        return "".join(f"<{r}:{t if i == len(messages) - 1 else ''}>" for i, (r, t) in enumerate(messages))

    state = cf.Incremental(last_only)
    assert [state.add("user", t)[-1] for t in ("a", "b")] == [True, False]

    def by_depth(messages):  # says how far back the history goes
        return "".join(f"<{i}:{t}>" for i, (_, t) in enumerate(messages))

    state = cf.Incremental(by_depth, window=4, overlap=2)
    assert [state.add("user", "x")[-1] for _ in range(6)] == [True] * 4 + [False] * 2


def _brute(rows):
    convs = {}
    for c, n, r, t in rows:
        convs.setdefault(c, []).append((n, r or "", t or ""))
    out = {}
    for c, turns in convs.items():
        turns.sort(key=lambda x: (x[0] is not None, x[0] if x[0] is not None else 0, x[1], x[2]))
        loss = "".join(t for _, r, t in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest(),
                  len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def _got(df):
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"])
            for r in df.collect()}


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    assert _got(op1_chat_format(spark, SF)) == _brute(rows)


def test_edge_rows(spark):
    schema = "conv_id bigint, turn bigint, role string, text string, piece int, start int"
    rows = [(None, 0, "user", "a", 1, 1), (None, 0, "assistant", None, 1, 1), (1, None, None, None, 1, 1),
            (1, 2, "assistant", "b" * 100_000, 1, 1), (1, 2, "assistant", "b" * 100_000, 1, 1), (2, 0, "assistant", "", 1, 1)]
    rows += [(3, i, "user" if i % 2 == 0 else "assistant", f"t{i}", 1, 1) for i in range(200)]
    df = spark.createDataFrame(rows, schema)
    got = _got(cf.digests(cf.format_turns(df)))
    assert got == _brute([r[:4] for r in rows])
    turns = cf.format_turns(df)
    assert turns.count() == len(rows) and turns.filter("not append_only").count() == 0
    assert cf.digests(cf.format_turns(df.filter("false"))).count() == 0


def _templates():
    """Local functions, so that workers get them by value: one says how far back
    the history goes, one keeps the last 40 messages only."""
    return (lambda messages: "".join(f"<{i}:{r}:{t}>" for i, (r, t) in enumerate(messages)),
            lambda messages: "".join(f"<{r}:{t}>" for r, t in messages[-40:]))


def test_prefixes_are_whole_beyond_any_length():
    assert cf._common("abcde", "abxde") == 2 and cf._common("ab", "abc") == 2 and cf._common("", "a") == 0
    by_depth, last_forty = _templates()
    state = cf.Incremental(by_depth)
    assert all(state.add("user", "x")[-1] for _ in range(100))
    state = cf.Incremental(last_forty)
    assert [state.add("user", str(i))[-1] for i in range(60)] == [True] * 40 + [False] * 20


def test_long_conversations_over_tasks_against_whole_prefixes(spark):
    convs = {c: [("user" if i % 2 == 0 else "assistant", f"t{c}.{i}") for i in range(n)]
             for c, n in ((None, 50), (1, 7), (2, 16), (3, 17), (4, 300))}
    df = spark.createDataFrame([(c, i, *m) for c, ms in convs.items() for i, m in enumerate(ms)],
                               "conv_id bigint, turn bigint, role string, text string")
    for render in (*_templates(), cf.render_marked):
        expected = []
        for c, ms in convs.items():
            outs = ["", *(render(ms[:i + 1]) for i in range(len(ms)))]
            for i, (a, b) in enumerate(zip(outs, outs[1:])):
                cut = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
                lo = hi = -1
                if ms[i][0] == "assistant" and b.startswith(a):
                    lo = b.index(ms[i][1], cut)
                    hi = lo + len(ms[i][1])
                expected.append((c, i, ms[i][0], b[cut:], cut, len(b), lo, hi, b.startswith(a)))
        for block in (16, 256):
            got = [tuple(r) for r in cf.format_turns(df, render, block=block).collect()]
            assert sorted(got, key=str) == sorted(expected, key=str)
            for c, ms in convs.items():  # together and in order
                assert [r[1] for r in got if r[0] == c] == list(range(len(ms)))
    whole, dealt = (cf.digests(cf.format_turns(df, block=b)).collect() for b in (256, 16))
    assert sorted(map(str, whole)) == sorted(map(str, dealt)) and len(whole) == len(convs)
