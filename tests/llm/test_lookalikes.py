import pytest

from inkframe.llm.lookalikes import Normalizer, letter_pairs, normalize_texts

TEXTS = ["the quick brown fox jumps over the lazy dog and says nothing more about it", "съешь же ещё этих мягких французских булок да выпей чаю сегодня в саду", "Ξεσκεπάζω την ψυχοφθόρα βδελυγμία του κόσμου"] * 20


@pytest.fixture(scope="module")
def norm():
    codes, n = letter_pairs(TEXTS)
    return Normalizer(dict(zip(codes.tolist(), n.tolist())))


SAME = [
    ("ｕｎｄ １２", "und 12"), ("thе quіck", "the quick"), ("café", "café"), ("ﬁrst oﬃce", "first office"), ("a​b­c﻿", "abc"), ("a b c　d", "a b c d"),
    ("well‑known ‐", "well-known -"), ("⼥井⽯", "女井石"), ("загоvоpит булок", "загоvорит булок"), ("полoжил сад", "положил сад"), ("ѕ́wiec", "świec"), ("ΑΒΕ fox", "ABE fox"), ("了", "了"),
]
DIFFERENT = [("the", "The"), ("cafe", "café"), ("18", "¹8"), ("7", "⑦"), ("it's", "it’s"), ("a.", "a!"), ("a b", "ab"), ("½", "1/2"), ("，", ","), ("a-b", "a–b"), ("fox", "foxes")]


@pytest.mark.parametrize("a,b", SAME)
def test_same_look(norm, a, b):
    assert norm.form(a) == norm.form(b)


@pytest.mark.parametrize("a,b", DIFFERENT)
def test_visible_difference(norm, a, b):
    assert norm.form(a) != norm.form(b)


def test_reading_is_of_one_script(norm):
    assert norm.form("thе fох") == "the fox"
    assert norm.form("съeшь жe чaю в сaду") == "съешь же чаю в саду"
    for t in TEXTS[:3]:
        assert norm.form(t) == t
    assert norm.form(norm.form("Thе ﬁrst ｆｏх")) == norm.form("Thе ﬁrst ｆｏх")


def test_table(spark):
    rows = [(1, "cоat"), (2, None), (3, ""), (4, "​"), (1, "cоat"), (5, "х" * 100_000)]
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], "id int, t string, canonical string")
    got = sorted((r.id, r.canonical is None, (r.canonical or "")[:4]) for r in normalize_texts(spark, df, "t").collect())
    assert got == [(1, False, "coat"), (1, False, "coat"), (2, True, ""), (3, False, ""), (4, False, ""), (5, False, "xxxx")]
    assert normalize_texts(spark, df.limit(0), "t", digest_only=True).count() == 0


@pytest.mark.parametrize("a,b", [("ɑpple", "apple"), ("ᏟᎪT", "CAT"), ("Ⲟld", "Old"), ("ᴏꓲd", "oId"), ("5 µm", "5 μm"), ("5 µm в саду", "5 μm в саду"), ("ꓮꓐꓚ", "АВС")])
def test_letters_of_further_scripts(norm, a, b):
    assert norm.form(a) == norm.form(b)


def test_unseen_pairs_cost_most_whatever_the_corpus():
    codes, n = letter_pairs(TEXTS)
    small, large = (Normalizer(dict(zip(codes.tolist(), (n * k).tolist()))) for k in (1, 10**9))
    assert small.bits == large.bits and max(large.bits.values()) < large._pair("q", "z")
    rare = Normalizer({**dict(zip(codes.tolist(), (n * 10**9).tolist())), ord("z") * 0x530 + ord("q"): 1})
    assert rare._pair("z", "q") <= rare._pair("q", "z")


def test_every_word_is_searched_with_fewest_changes_of_script(norm):
    """Brute force over all readings of short looks."""
    import itertools
    import unicodedata

    from inkframe.llm.lookalikes import _script

    for word in ("cab", "Топ", "жaр", "wож", "хос", "ΑΒж", "ewo"):
        look = norm._look(word)
        rows = [{s: x for s, x in enumerate(norm.members[c]) if x != "-"} if c in norm.members else {_script(c): c} for c in look]
        for lean in (0, 1, 2):

            def cost(path):
                letters = [r[s] for r, s in zip(rows, path)]
                bits = sum(norm._pair(a, b) for a, b, p, q in zip(letters, letters[1:], path, path[1:]) if p == q)
                return sum(p != q for p, q in zip(path, path[1:])), path[0] != lean, round(bits, 6)

            best = min(map(cost, itertools.product(*rows)))
            got = norm._viterbi(look, lean)
            assert any(unicodedata.normalize("NFC", "".join(r[s] for r, s in zip(rows, p))) == got and cost(p) == best for p in itertools.product(*rows))
