"""Text rules: markup stripping (against a line-by-line Python model),
blank documents, sentences, character tokens, key-value text."""

import random
import re

from webcorpus.functions import text as TX
from webcorpus.operators import corpus as C


def without(line, opening, closing):
    """The line without anything from ``opening`` to the next ``closing``, by plain searches."""
    out = ""
    while True:
        head, found, rest = line.partition(opening)
        _, ended, tail = rest.partition(closing)
        if not (found and ended):
            return out + line
        out, line = out + head, tail


def model_clean(text):
    """Display math, then tags, go from each line; then its leading spaces, and
    trailing ones where no line end follows."""
    lines = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
    done = []
    for i, line in enumerate(lines):
        line = without(line, '<span class="katex--display">', "</span><br/>")
        line = without(line, "<", ">").lstrip(" ")
        done.append(line.rstrip(" ") if i == len(lines) - 1 else line)
    return "\n".join(done)


def _docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


EDGE = [
    'a <span class="katex--display">x<b>y</b></span><br/> b\n',
    "<p>tag broken\nover two</p> lines\n",
    "<> empty tag\n",
    "a<b and c>d\n",
    "   leading and trailing   \n   last line without newline   ",
    "lone\rcarriage\r\nreturn\n",
    "next line\u0085stays one line <i>x</i>\n",
    "",
    "&amp; entities stay &lt;b&gt;\n",
    "<script>var t=\"</p>\";</script>text\n",
]


def test_strip_markup_edge_cases(spark):
    got = dict(C.strip_markup(_docs(spark, EDGE), "text", "doc_id").collect())
    for i, t in enumerate(EDGE):
        assert got[i] == model_clean(t), (t, got[i], model_clean(t))


def test_strip_markup_random_against_model(spark):
    rnd = random.Random(7)
    pieces = ["<", ">", " ", "  ", "\n", "\r\n", "\r", "a", "b", "/", "<b>", "</b>", "<br/>",
              '<span class="katex--display">', "</span>", "</span><br/>", "中", "é", "\t", "<p\n>"]
    texts = ["".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 30))) for _ in range(400)]
    got = dict(C.strip_markup(_docs(spark, texts), "text", "doc_id").collect())
    bad = [(t, got[i], model_clean(t)) for i, t in enumerate(texts) if got[i] != model_clean(t)]
    assert not bad, bad[:3]


def test_drop_blank_keeps_newline_only(spark):
    texts = ["", "   ", "\n", " \n ", "x", None, "\t"]
    got = {r.doc_id for r in C.drop_blank(_docs(spark, texts)).collect()}
    expect = {i for i, t in enumerate(texts) if t is not None and t.strip(" ") != ""}
    assert got == expect == {2, 3, 4, 6}


def test_sentences_and_char_tokens(spark):
    texts = ["你好。今天天气很好！是吗？好", "Pi is 3.14 here. Next one!  Last?", "\n\n", "   ", "emoji 😀 ok. x",
             "line one\nline two. three"]
    df = _docs(spark, texts)
    sents = {}
    for r in C.sentence_rows(df).collect():
        sents.setdefault(r.doc_id, []).append((r.sent_no, r.sentence))
    assert [s for _, s in sorted(sents[0])] == ["你好。", "今天天气很好！", "是吗？", "好"]
    assert [s for _, s in sorted(sents[1])] == ["Pi is 3.14 here.", "Next one!", "Last?"]
    assert 2 not in sents and 3 not in sents
    assert [s for _, s in sorted(sents[5])] == ["line one\nline two.", "three"]
    lines = {(r.doc_id, r.sent_no): r.line for r in C.char_tokens(df).collect()}
    assert lines[(0, 0)] == "你 好 。 "
    assert lines[(4, 0)] == "e m o j i 😀 o k . "
    assert lines[(5, 0)] == "l i n e o n e l i n e t w o . "


def test_kv_map_rules(spark):
    rows = [("a=1; b=2",), (" a=1 ; a=3 ;",), ("k=v=w;x",), ("\n\tk=1;;",)]
    df = spark.createDataFrame(rows, "s string").select(TX.kv_map("s").alias("m"))
    got = [r.m for r in df.collect()]
    assert got[0] == {"a": "1", "b": "2"}
    assert got[1] == {"a": "3"}          # repeated key: last wins
    assert got[2] == {"k": "v=w", "x": None}  # split on first '='; no '=' -> null value
    assert got[3]["k"] == "1"


def test_trim_first_char_join(spark):
    df = spark.createDataFrame([("\n\t name \n", "", ["a", "b"]), ("x", "Lv5", ["a", None])],
                               "s string, g string, arr array<string>")
    r = df.select(TX.trim_chars("s").alias("t"), TX.first_char("g").alias("g"),
                  TX.join_titles("arr").alias("j")).collect()
    assert (r[0].t, r[0].g, r[0].j) == ("name", None, "a/b")
    assert (r[1].t, r[1].g, r[1].j) == ("x", "L", None)


def test_read_count(spark):
    df = spark.createDataFrame([("阅读数 123",), ("阅读数",), ("阅读 5",), ("x阅读数  42 y",)], "s string")
    assert [r[0] for r in df.select(TX.read_count("s")).collect()] == ["123", "", None, "42"]


def test_preview_is_ordered_top_n(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "k int, v string")
    assert [r.k for r in C.preview(df, ["k"]).collect()] == [1, 2]


def test_read_count_unicode_classes_like_python(spark):
    import re as pyre
    vals = ["阅读数　１２", "阅读数 7", "阅读数  3"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(TX.read_count("s")).collect()]
    assert got == [pyre.search(r"(?<=阅读数)\s*(\d*)", v).group(1) for v in vals]


def test_kv_map_random_against_python(spark):
    rnd = random.Random(4)

    def model(s):
        pairs = [re.fullmatch(r"\s*([^=]*)=(.*?)\s*", part, re.DOTALL).groups() for part in s.split(";")]
        return dict(pairs)
    keys, vals = ["a", "b", "sid", "x_y"], ["1", "", "v=w", "a b", "é", "=="]
    texts = []
    for _ in range(300):
        items = [f"{rnd.choice(keys)}={rnd.choice(vals)}" for _ in range(rnd.randint(1, 5))]
        texts.append("".join(rnd.choice(["", " ", "  "]) + it + rnd.choice(["", " "]) + ";" for it in items)[:-1])
    df = spark.createDataFrame([(t,) for t in texts], "s string").select(TX.kv_map("s").alias("m"))
    got = [r.m for r in df.collect()]
    bad = [(t, g, model(t)) for t, g in zip(texts, got) if g != model(t)]
    assert not bad, bad[:3]
