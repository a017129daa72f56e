"""Layers, scripts and sizes that the test tables do not show."""

import random

import numpy as np
import pytest

from inkframe.llm.mojibake import ASK, LEAST_SHARE, Rarity, Repair, count_pairs

KOREAN = "그는 오래된 방앗간 앞에서 한국 사람을 기다렸다. 아무도 그 편지를 믿지 않았고, 비는 밤새 내렸다."
JAPANESE = "彼は古い水車の前で駅から来る人を待っていた。誰もその手紙を信じなかった。雨は一晩中降った。"
CHINESE = "雾离在磨坊底下找到了珍珠，外面裹着金色的布。你好，没有人相信他能修好那破损的旧照。"
FRENCH = "« Je n’ai jamais demandé la théière », répéta Rosé, et la forêt était là, où l’été s’achève."
GERMAN = "Für Lea war das Gebäude nur ein kühler Ort; später fand sie den Schlüssel hinter der Mühle."
TAIWAN = "他在車站後面把鑰匙埋下，門外的雨還沒有停，誰也說不清緣由，後來只寄回一張舊照片。"
ALL = [KOREAN, JAPANESE, CHINESE, FRENCH, GERMAN, TAIWAN]


def repair(times=1, extra=(), n=1000):
    codes, k = count_pairs([*(t for t in ALL for _ in range(n)), *extra], shapes=False)
    return Repair(Rarity((codes, k * times)))


CASES = [
    (KOREAN.encode().decode("latin-1"), KOREAN), (JAPANESE.encode().decode("cp437"), JAPANESE), (KOREAN.encode("cp949").decode("latin-1"), KOREAN), (CHINESE.encode("gb18030").decode("latin-1"), CHINESE),
    ("Er sagte „ÄãºÃ“ und ging.", "Er sagte „你好“ und ging."), (TAIWAN.encode("big5").decode("gb18030"), TAIWAN), (FRENCH.encode("cp1252").decode("mac_roman"), FRENCH), (GERMAN.encode("cp1252").decode("cp437"), GERMAN),
    (GERMAN.encode().decode("gb18030", "replace"), None), (JAPANESE.encode("iso2022_jp").decode("ascii"), JAPANESE), ("He said ~{<:Ky2;~} and left.", None), ("+AGEA6QDpAOk-", None),
]


@pytest.mark.parametrize("times", [1, 10**6])
def test_same_answers_for_any_size_of_corpus(times):
    r = repair(times)
    for t in ALL:
        assert r.text(t) == (False, t), t
    assert [r.text(bad) for bad, _ in CASES] == [repair().text(bad) for bad, _ in CASES]
    found = [r.text(bad)[0] for bad, _ in CASES[:-1]]
    assert all(found), [bad for (bad, _), f in zip(CASES, found) if not f]
    assert sum(r.text(bad)[1] == good for bad, good in CASES) >= 8


def test_korean_pairs_are_known():
    r = repair()
    assert max(r.worst(w) for w in "방앗간 한국 편지를".split()) <= ASK < r.rarity.bits(ord("뷁"), ord("쀍"))


def test_five_layers():
    bad = "Der Schlüssel war da."
    for _ in range(5):
        bad = bad.encode().decode("latin-1")
    assert repair().text(bad) == (True, "Der Schlüssel war da.")


def test_garbling_in_a_third_of_all_rows():
    bad = [t.encode().decode("cp1252", "ignore") for t in (FRENCH, GERMAN) for _ in range(1500)]
    r = repair(extra=bad)
    assert r.text("Der SchlÃ¼ssel war da, et l’Ã©tÃ© aussi.") == (True, "Der Schlüssel war da, et l’été aussi.")


def test_one_cost_by_two_ways():
    rng, r = random.Random(3), repair()
    chars = [ord(c) for c in set("".join(ALL))] + [0x4E8D, 0xFFFD, 65, 32, 0x1F600]
    c = np.array([rng.choice(chars) for _ in range(3000)], dtype=np.int64)
    assert np.allclose(r.rarity.all_bits(c), [r.rarity.bits(int(a), int(b)) if a > 127 or b > 127 else 0 for a, b in zip(c[:-1], c[1:])])


def test_model_is_bounded(spark):
    from inkframe.llm.mojibake import model
    from inkframe.scratch import Scratch

    big = int(4 / LEAST_SHARE)
    df = spark.createDataFrame([(1 << 22, big), ((1 << 22) + 1, 1), ((1 << 22) + 2, 8), (0x4E00, 1)], "code bigint, n bigint")
    assert sorted(model(df, Scratch(spark, "t"))[0].tolist()) == [0x4E00, 1 << 22, (1 << 22) + 2]
