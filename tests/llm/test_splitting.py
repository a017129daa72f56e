import random

from pyspark.sql import functions as F

from inkframe.llm.splitting import split_texts

DDL = "id int, t string, lim int, ov int, pieces string, own string"


def run(spark, rows):
    df = spark.createDataFrame([(i, t, a, b, "clash", "clash") for i, (t, a, b) in enumerate(rows)], DDL)
    return {r.id: r.pieces for r in split_texts(df, "t", "lim", "ov").select("id", "pieces").collect()}


def tokens(b):
    return max(1, -(-len(b) // 3))


def check(text, lim, ov, pieces):
    raw, back = text.encode(), b""
    for k, p in enumerate(pieces):
        got = p.text.encode()
        assert p.piece_no == k and raw[p.start_byte : p.start_byte + len(got)] == got
        assert tokens(got) <= max(4, lim) and p.own_byte == len(back)
        if k:
            shared = p.own_byte - p.start_byte
            assert shared <= 3 * ov and shared > min(p.own_byte, 3 * min(ov, max(4, lim) // 2)) - 4
        back += got[p.own_byte - p.start_byte :]
    assert back == raw


def test_round_trip_and_limits(spark):
    rng = random.Random(1)
    bits = ["Word ", "sentence. ", "“Quoted!” ", "\n\n", "\n", "句子很长。", "，", "𝔘", "é", "x" * 50, "\r\n\r\n", "! ", "一" * 40]
    rows = [("".join(rng.choice(bits) for _ in range(rng.randrange(0, 120))), rng.choice([4, 10, 40, 160]), rng.choice([0, 1, 3, 20])) for _ in range(60)]
    got = run(spark, rows)
    for i, (t, lim, ov) in enumerate(rows):
        check(t, lim, ov, got[i])


def test_natural_boundaries(spark):
    text = "First part here. Second part is here. " + "Third one goes on. " * 3
    pieces = run(spark, [(text, 12, 0)])[0]
    assert all(p.text.endswith(". ") for p in pieces)
    zh = "雾离在磨坊底下找到了珍珠。外面裹着金色的布。" * 4
    assert all(p.text.endswith("。") for p in run(spark, [(zh, 30, 3)])[0])


def test_edges(spark):
    got = run(spark, [(None, 5, 1), ("", 5, 1), ("abc", None, 1), ("x" * 15, 5, None), ("x" * 16, 5, -3), ("x" * 40, 5, 99), ("啊" * 20, 0, 0)])
    assert got[0] is None and got[2] is None
    assert [p.text for p in got[1]] == [""] and len(got[3]) == 1 and len(got[4]) == 2
    check("x" * 40, 5, 2, got[5])
    check("啊" * 20, 4, 0, got[6])


def test_long_text_without_breaks(spark):
    text = "啊" * 200_000
    pieces = run(spark, [(text, 2400, 200)])[0]
    check(text, 2400, 200, pieces)


def test_empty_table(spark):
    assert split_texts(spark.createDataFrame([], DDL), "t", "lim", "ov").where(F.size("pieces") > 1).count() == 0


def test_budgets_of_one_to_three_tokens(spark):
    texts = ["abc def. ghi", "日本語です", "a😀b😀😀c", "é" * 9]
    rows = [(t, n) for t in texts for n in (0, 1, 2, 3)]
    df = split_texts(spark.createDataFrame([(t, n, 2) for t, n in rows], "t string, n int, o int"), "t", "n", "o")
    for r in df.collect():
        assert "".join(p.text for p in r.pieces) == r.t
        for p in r.pieces:
            assert -(-len(p.text.encode()) // 3) <= max(1, r.n) or (r.n < 2 and p.text == "😀"), (r.n, p.text)
