import pytest

from inkframe.llm.residue import judge_residue, verdict

RESIDUE = [
    ("It was {{ hero.name }} who found the bell.", "placeholder"), ("Dear [Name], welcome to ${city}.", "placeholder"), ("Name: ___________\nHome: Saltford", "placeholder"), ("等{author|default}先开口", "placeholder"),
    ("《日期待定》的站台", "placeholder"), ("[TODO: villain] laughed", "placeholder"), ("said undefined. “The bell rang.”", "placeholder"), ("%(date)s and %s", "placeholder"),
    ("Reader 4.0\nPlease enable JavaScript to view this chapter!\nHelp | Terms", "notice"), ("您的浏览器已禁用脚本，请开启后继续阅读。", "notice"), ("HTTP 404\nThe page could not be found.\nReference 12ab34cd", "notice"),
    ('Traceback (most recent call last):\n  File "fetch.py", line 12, in run\nTimeoutError: read timed out', "notice"), ('{"error": {"code": 429, "message": "quota exceeded", "request_id": "ab12cd34"}}', "notice"),
    ("Lorem ipsum dolor sit amet, consectetur adipiscing", "notice"), ("测试文本" * 30, "notice"), ("foo bar " * 40, "filler"), ("日期：暂无\n城市：略\n概要：……", "filler"), ("jkwqj jwjf jkkejl sqlwkkj akad kqwedkkla lsawqe jeldk", "filler"),
]
REAL = [
    "The sign on the door read “error 404”, and Milo laughed at the joke.", "“Please enable the lights,” she typed, but the old terminal answered only: access denied. Then dusk fell over the quiet harbour.",
    "The telegram ran: COME SOON STOP [SIGNED] Milo STOP.", "Under tags {fog, rain, late train} Milo filed the cane beside pages %15 to %30 of the primer.", "On the form he left the line empty; Ada signed [with an X].",
    "First part of it ends.\n_______________\nThe second part begins.", "In the margin he had pencilled “undefined”, and under it: null and void.", "The chant went dolvem ipsaro nolem, three times, until Milo slept at last by the window.", "", None, "a", "【第1场】芦林驿 夜 内\n[他数了60步，磨坊忽然暗了下来。]", "She used C[0] and x[i].",
]


@pytest.mark.parametrize("text,why", RESIDUE)
def test_residue(text, why):
    assert verdict(text)[::2] == (True, why)


@pytest.mark.parametrize("text", REAL)
def test_real(text):
    assert not verdict(text)[0]


def test_long_text_is_read_whole(spark):
    rows = [(1, "word and more words here in the tale, " * 30_000 + "{{city}}"), (2, None), (1, "fine text of a tale")]
    got = sorted((r.k, r.residue, r.reason) for r in judge_residue(spark.createDataFrame([(k, t, "x") for k, t in rows], "k int, t string, residue string"), "k", "t").collect())
    assert got == [(1, False, ""), (1, True, "placeholder"), (2, False, "")]
    assert judge_residue(spark.createDataFrame([], "k int, t string"), "k", "t").count() == 0


UNIT = "Here stands a whole sentence of our own that nobody wrote for this tale, and it says nothing. "


@pytest.mark.parametrize("text", [UNIT * 40, "Chapter Five: the Mill at Dusk\n" + UNIT * 12 + "The end", "名称：暂无\n" * 400, "foo " * 30 + "x"])
def test_repeats_and_forms_of_any_length(text):
    assert verdict(text)[::2] == (True, "filler")


def test_a_refrain_is_no_filler():
    assert not verdict("".join(f"Verse {w} of the long song tells of {w} again. " + UNIT for w in "oak elm ash fir yew bay".split()))[0]
