import random

import pytest

from inkframe.llm.mojibake import repair_texts

PLAIN = [
    "« Je n’ai jamais demandé la théière », répéta Milo, et Rosé se tourna vers la forêt.", "Für Lea war das Gebäude nur ein kühler Ort; später fand sie den Schlüssel hinter der Mühle.",
    "¿Quién escondió el violín roto detrás de la estación? Según contó después, fue mañana.", "Nikt nie wierzył, że znajdzie źdźbło trawy; położył mapę żeglarza na stole i czekał, aż się odezwie.",
    "К рассвету он уже прошёл двор и дважды потерял письмо за старой мельницей.", "雾离在磨坊底下找到了珍珠，外面裹着金色的布。没有人相信他能修好那破损的旧照。", "“Keep the coat until dusk,” whispered Zoë—the well didn’t close.",
    "A AVIAÇÃO já não existe, murmurou junto ao órgão; NÃO TOQUE EM NADA.",
]
CONTROLS = ["ÂNGULO DA MAÇÃ, SÃO VELMOR.", "Þórvel ok Ðani.", "«Œuvre», 3 £ – ©", "(Åsgrund, ¥120, §4)", "Θ = 4½°, µ ≈ 0.3", "L'ÉTÉ OÙ", "plain ascii only", ""]
WAYS = [("utf-8", "cp1252"), ("utf-8", "latin-1"), ("utf-8", "cp437"), ("utf-8", "mac_roman"), ("utf-8", "cp1251"), ("cp1252", "cp437"), ("cp1252", "mac_roman"), ("cp1250", "cp1252"), ("cp1251", "latin-1"), ("koi8-r", "cp1251"), ("gb18030", "latin-1")]


@pytest.fixture(scope="module")
def result(spark):
    rng = random.Random(4)
    rows, truth = [], {}
    for i in range(3000):
        rows.append((i, " ".join(rng.sample(PLAIN, 2)), "x"))
    for k, text in enumerate(CONTROLS * 30):
        rows.append((10_000 + k, text, "x"))
    k = 20_000
    for text in PLAIN:
        for right, wrong in WAYS:
            try:
                bad = text.encode(right).decode(wrong)
            except (UnicodeEncodeError, UnicodeDecodeError):
                continue
            if bad != text:
                rows.append((k, bad, "x"))
                truth[k] = text
                k += 1
    for text in PLAIN[:2]:
        rows.append((k, text.encode().decode("latin-1").encode().decode("latin-1"), "x"))
        truth[k] = text
        k += 1
    rows += [(30_000, "Der Schl�ssel war da.", "x"), (30_001, None, "x"), (30_000, "Der Schl�ssel war da.", "x")]
    df = spark.createDataFrame(rows, "id int, t string, garbled string").drop("garbled")
    return rows, truth, {r.id: r for r in repair_texts(spark, df, "id", "t").collect()}


def test_nothing_right_is_touched(result):
    rows, _, got = result
    for i, text, _ in rows:
        if i < 20_000:
            assert not got[i].garbled and got[i].restored == text, text


def test_garbled_is_found_and_mostly_restored(result):
    _, truth, got = result
    found = sum(got[k].garbled for k in truth)
    whole = sum(got[k].restored == t for k, t in truth.items())
    assert found >= 0.95 * len(truth) and whole >= 0.8 * len(truth), (found, whole, len(truth))


def test_lost_bytes_and_null(result):
    _, _, got = result
    assert got[30_000].garbled and not got[30_001].garbled and got[30_001].restored is None


def test_empty_table(spark):
    assert repair_texts(spark, spark.createDataFrame([], "id int, t string"), "id", "t").count() == 0


@pytest.mark.parametrize("text", ["他说锟斤拷，走了。", "Der ï¿½ war da.", "Он пїЅ ушёл.", "嚙踝蕭", "Ã¯Â¿Â½", "Â“HelloÂ”"])
def test_lost_bytes_written_again_are_found_whatever_is_common(text):
    """A corpus full of them makes their pairs cheap; they are no less lost."""
    from inkframe.llm.mojibake import Rarity, Repair, count_pairs

    codes, n = count_pairs([*PLAIN, text] * 500)
    assert Repair(Rarity(dict(zip(codes.tolist(), n.tolist())))).text(text)[0]


@pytest.mark.parametrize("text", ["«План В»", "В… и С—", "groß“ é »", "ROMÂ”", "他拷问了敌人", *PLAIN])
def test_right_signs_after_capitals_are_not_lost(text):
    from inkframe.llm.mojibake import _lost

    assert not _lost(text)


def test_usual_garbling_is_tried():
    """One kind of garbling in so many texts that its pairs are below the gate."""
    from inkframe.llm import mojibake as M

    right = [t for t in [*PLAIN[:3], "été jeté, la clé et le thé. "] for _ in range(300)]
    bad = "Il a jetÃ© la clÃ© et le thÃ©."
    codes, n = M.count_pairs(right + [bad] * 20)
    repair = M.Repair(M.Rarity(dict(zip(codes.tolist(), n.tolist()))))
    assert all(repair.worst(m.group()) <= M.ASK for m in M._TOKEN.finditer(bad))
    assert repair.text(bad)[0]
