import random

from inkframe.llm.leakage import find_leaks, smith_waterman, words

VOC = [f"w{i}" for i in range(3000)]
HAN = [chr(0x4E00 + i) for i in range(2500)]


def make(seed=3):
    rng = random.Random(seed)
    items = [(i, " ".join(rng.choices(VOC, k=80))) for i in range(20)] + [(100 + i, "".join(rng.choices(HAN, k=120))) for i in range(10)]
    docs, truth = [], set()
    common = [" ".join(rng.choices(VOC, k=9)) for _ in range(20)]
    for d in range(400):
        text = " ".join(rng.choice(common) for _ in range(12))
        if d % 4 == 0:
            i, t = items[rng.randrange(20)]
            w = t.split()
            n = rng.choice([10, 19, 30, 45])
            at = rng.randrange(80 - n)
            part = w[at : at + n]
            if n >= 30:
                for k in rng.sample(range(2, n - 2), n // 10):
                    part[k] = rng.choice(["odd", part[k] + " extra", ""])
                truth.add((d, i))
            text += " " + " ".join(part).upper().replace("  ", " ") + ".\n" + rng.choice(common)
        elif d % 4 == 1:
            i, t = items[20 + rng.randrange(10)]
            n = rng.choice([20, 34, 60, 90])
            at = rng.randrange(120 - n)
            part = list(t[at : at + n])
            if n >= 60:
                for k in rng.sample(range(2, n - 2), n // 10):
                    part[k] = rng.choice(["了", ""])
                truth.add((d, i))
            text += "，".join(["".join(part[:17]), "".join(part[17:])])
        elif d % 4 == 2:
            i, t = items[rng.randrange(20)]
            w = t.split()
            rng.shuffle(w)
            text += " " + " ".join(w)
        docs.append((d, text))
    return items, docs, truth


def test_planted_passages(spark):
    items, docs, truth = make()
    docs += [(1000, None), (1001, ""), (1002, items[0][1]), (1002, items[0][1])]
    df = spark.createDataFrame([(k, t, "x") for k, t in docs], "doc bigint, text string, item string").repartition(5)
    it = spark.createDataFrame(items + [(500, None), (501, "too short")], "item bigint, text string")
    rows = find_leaks(spark, df.drop("item"), "doc", "text", it, "item", "text").collect()
    got = {(r.doc, r.item) for r in rows}
    assert got == truth | {(1002, 0)}
    assert sum(r.doc == 1002 for r in rows) == 2


def test_passages_that_a_third_of_all_documents_hold(spark):
    """Rarity must not depend on how often the passage itself has leaked."""
    rng = random.Random(5)
    item, han = " ".join(rng.choices(VOC, k=80)), "".join(rng.choices(HAN, k=120))
    docs, truth = [], set()
    for d in range(120):
        part, chars = item.split()[20:50], list(han[20:80])
        for k in rng.sample(range(3, 27), 3):
            part[k] = f"odd{d}"
        for k in rng.sample(range(3, 57), 6):
            chars[k] = rng.choice("了的是")
        docs += [(3 * d, " ".join(rng.choices(VOC, k=20) + part + rng.choices(VOC, k=20))), (3 * d + 1, "".join(rng.choices(HAN, k=20) + chars))]
        docs.append((3 * d + 2, " ".join(rng.choices(VOC, k=20) + item.split()[20:39] + rng.choices(VOC, k=20))))
        truth |= {(3 * d, 1), (3 * d + 1, 2)}
    df = spark.createDataFrame(docs, "doc bigint, text string")
    it = spark.createDataFrame([(1, item), (2, han)], "item bigint, text string")
    assert {(r.doc, r.item) for r in find_leaks(spark, df, "doc", "text", it, "item", "text").collect()} == truth


def test_empty(spark):
    d, i = spark.createDataFrame([], "doc bigint, text string"), spark.createDataFrame([], "item bigint, text string")
    assert find_leaks(spark, d, "doc", "text", i, "item", "text").count() == 0
    assert find_leaks(spark, d, "doc", "text", spark.createDataFrame([(1, "a b c " * 20)], "item bigint, text string"), "item", "text").count() == 0


def test_alignment_against_plain_table():
    import numpy as np

    rng = random.Random(8)
    for _ in range(60):
        a, b = [rng.randrange(1, 6) for _ in range(15)], [rng.randrange(1, 6) for _ in range(18)]
        h, best = [[0] * 19 for _ in range(16)], 0
        for i in range(1, 16):
            for j in range(1, 19):
                h[i][j] = max(0, h[i - 1][j - 1] + (1 if a[i - 1] == b[j - 1] else -3), h[i - 1][j] - 3, h[i][j - 1] - 3)
                best = max(best, h[i][j])
        matched, start, length = smith_waterman(np.array(a), np.array(b))
        assert matched >= best and 0 <= start and start + length <= 18 and (best == 0 or matched > 0)


def test_words():
    assert words("Don’t <b>stop</b>, lamp-\nlighting É1") == ["dont", "stop", "lamplighting", "e1"]
    assert words("码头Zoë低") == ["码", "头", "zoe", "低"] and words(None) == []


def test_items_of_any_length(spark):
    """Passages far into an item of 6,000 words, and a document of many times a passage's length."""
    rng = random.Random(11)
    item = rng.choices(VOC, k=6000)
    docs = [(0, " ".join(item[5000:5060])), (1, " ".join(item[100:160])), (2, " ".join(rng.choices(VOC, k=9000) + item[2000:2040] + rng.choices(VOC, k=900))), (3, " ".join(item[5000:5019])), (4, " ".join(item))]
    df, it = spark.createDataFrame(docs, "doc bigint, text string"), spark.createDataFrame([(7, " ".join(item))], "item bigint, text string")
    got = {r.doc: (r.matched, r.first_word, r.n_words) for r in find_leaks(spark, df, "doc", "text", it, "item", "text").collect()}
    assert got == {0: (60, 0, 60), 1: (60, 0, 60), 2: (40, 9000, 40), 4: (6000, 0, 6000)}


def test_many_items_in_blocks(spark, monkeypatch):
    from inkframe.llm import leakage

    rng = random.Random(12)
    items = [(i - 2500, " ".join(rng.choices(VOC, k=60))) for i in range(5000)]
    docs = [(d, " ".join(rng.choices(VOC, k=10)) + " " + " ".join(t.split()[10:50])) for d, (_, t) in enumerate(items[::250])]
    df, it = spark.createDataFrame(docs, "doc bigint, text string"), spark.createDataFrame(items, "item bigint, text string")
    truth = {(d, i) for d, (i, _) in enumerate(items[::250])}
    for block in (leakage.BLOCK, 700_000):
        monkeypatch.setattr(leakage, "BLOCK", block)
        assert {(r.doc, r.item) for r in find_leaks(spark, df, "doc", "text", it, "item", "text").collect()} == truth
