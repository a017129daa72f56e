"""Garbled text from wrong character encodings: find it and restore the original.

Round-trip repair. Text that was decoded as encoding W although it had been written in R is put right
by encoding it as W and decoding it strictly as R. Both are tried for a list of encodings, on the
smallest stretches that can be told apart (a sequence of bytes that R must take as one character, or
a word), and again on the result, for nested layers. A step is accepted when a garbling cost drops:
the cost of a stretch is the rarity of its characters in their company, by counts of pairs of
neighbouring characters over the whole corpus. Garbled pairs are rare and what they stand for is
common; unusual but right characters either do not round-trip or become rarer.

Only shares of the corpus count, not its size, and what has the shape of UTF-8 read as something else is
left out of the counts, so garbling is not made usual by being frequent. A whole batch is screened at
once; only texts with something rare or of such a shape are looked at word by word.

Texts with a replacement character (U+FFFD) or C1 control characters hold a wrongly decoded sequence
whatever can be made of it; so do texts with what became of these when they were written as UTF-8 and
read as something else.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkframe.scratch import Scratch

# Encodings that texts are wrongly read as, and those that they were written in.
READ_AS = ["cp1252", "latin-1", "cp437", "mac_roman", "cp1251", "cp1250", "cp850", "koi8-r", "cp866", "iso8859-2", "gb18030", "big5", "cp932"]
WRITTEN_IN = ["gb18030", "cp1252", "cp1251", "koi8-r", "cp1250", "iso8859-2", "mac_roman", "cp437", "cp850", "cp866", "cp932", "big5", "cp949", "euc_jp"]

#: Least drop of the cost, in bits a pair of characters, for a step to count; and over a stretch.
DROP, TOTAL = 2.0, 9.0
#: A word is tried if it has a pair of characters of so many bits.
ASK = 11.5
#: Share of the pairs that an unseen one is taken to have: 18 bits, whatever the size of the corpus.
UNSEEN = 2.0**-18
#: Pairs of a smaller share than this are left out of the model: at most 2^22 remain, and a cost moves by
#: no more than log2(1 + 2^-4) = 0.09 bits.
LEAST_SHARE = 2.0**-22
#: Layers of lost bytes that are listed beforehand; those below more layers appear as these are undone.
LOSS_LAYERS = 3

_HAN = 0x4E00
_SURE = re.compile("[�\x80-\x84\x86-\x9f]")
_TOKEN = re.compile(r"[^\x00-\x20]*[^\x00-\x7f][^\x00-\x20]*")
#: Texts that may be garbled, as a pattern of SQL: not ASCII, or ASCII that carries other characters
#: (escapes of ISO 2022, HZ, UTF-7).
MAYBE = r"[^\x00-\x7F]|\x1B[$(]|~\{|\+[A-Za-z0-9+/]{3,}-"


def _is_han(c: np.ndarray) -> np.ndarray:
    return ((c >= 0x3400) & (c <= 0x9FFF)) | ((c >= 0xF900) & (c <= 0xFAFF)) | ((c >= 0xAC00) & (c <= 0xD7A3))


def _is_han1(c: int) -> bool:
    return 0x3400 <= c <= 0x9FFF or 0xF900 <= c <= 0xFAFF or 0xAC00 <= c <= 0xD7A3


def count_pairs(texts: list[str], shapes: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(pair codes, counts): neighbouring characters of which one is not ASCII, blanks and digits
    folded, ideographs as one class in pairs and counted singly (with 0 as their neighbour). Without
    `shapes`, what may be UTF-8 that was read in a single-byte encoding is left out."""
    c = np.frombuffer("\n".join(texts).encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.int64)
    if not len(c):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    odd = np.zeros(len(c), dtype=bool) if shapes else _shaped(c)
    c = _fold(c)
    han = _is_han(c)
    f = np.where(han, _HAN, c)
    far = ((f[:-1] > 127) | (f[1:] > 127)) & ~odd[:-1] & ~odd[1:]
    both = han[:-1] & han[1:]
    pairs = (f[:-1] << 21 | f[1:])[far & ~both]
    return np.unique(np.concatenate([pairs, c[han]]), return_counts=True)


def _shaped(c: np.ndarray) -> np.ndarray:
    """Which characters belong to a sequence of the shape of UTF-8 in some single-byte encoding. In cp866
    small Cyrillic letters alone have that shape: these are words."""
    lead2, lead3, lead4, tail, _ = _classes()
    low, n = np.minimum(c, 0xFFFF), len(c)
    goes_on = tail[low]
    odd = np.zeros(n, dtype=bool)
    for lead, k in ((lead2, 1), (lead3, 2), (lead4, 3)):
        if n > k:
            fits = lead[low[: n - k]]
            for j in range(1, k + 1):
                fits = fits & goes_on[j : n - k + j]
            at = np.flatnonzero(fits)
            at = at[~np.logical_and.reduce([(c[at + j] >= 0x430) & (c[at + j] <= 0x451) for j in range(k + 1)])]
            for j in range(k + 1):
                odd[at + j] = True
    return odd


def _fold(c: np.ndarray) -> np.ndarray:
    c = np.where((c >= 48) & (c <= 57), 48, c)
    return np.where((c <= 32) | (c == 0xA0) | (c == 0x3000) | ((c >= 0x2000) & (c <= 0x200A)), 32, c)


class Rarity:
    """Bits of surprise of neighbouring characters, from their shares in the corpus."""

    def __init__(self, counts: dict[int, int] | tuple[np.ndarray, np.ndarray]):
        if isinstance(counts, dict):
            counts = np.array(list(counts), dtype=np.int64), np.array(list(counts.values()), dtype=np.float64)
        order = np.argsort(counts[0])
        self.codes, n = counts[0][order], np.asarray(counts[1], dtype=np.float64)[order]
        far = self.codes >= 1 << 21
        total = np.where(far, n[far].sum(), n[~far].sum())
        self.rare = -math.log2(UNSEEN)
        self.costs = -np.log2(n / np.maximum(total, 1) + UNSEEN)
        self.memo: dict[tuple[int, int], float] = {}

    def look_up(self, codes: np.ndarray) -> np.ndarray:
        if not len(self.codes):
            return np.full(len(codes), self.rare)
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, self.costs[at], self.rare)

    def all_bits(self, c: np.ndarray) -> np.ndarray:
        """Bits of each character of a folded text with the one after it; 0 between ASCII characters."""
        out = np.zeros(max(0, len(c) - 1))
        at = np.flatnonzero((c[:-1] > 127) | (c[1:] > 127))
        a, b = c[at], c[at + 1]
        ha, hb = _is_han(a), _is_han(b)
        both, meet = ha & hb, ha != hb
        x = self.look_up(np.where(both, b, np.where(ha, _HAN, a) << 21 | np.where(hb, _HAN, b)))
        # where scripts meet, the ideograph counts too: a rare one does not belong there
        out[at] = np.where(meet, np.maximum(x, self.look_up(np.where(ha, a, b))), x)
        return out

    def _one(self, code: int) -> float:
        at = int(self.codes.searchsorted(code))
        return float(self.costs[at]) if at < len(self.codes) and self.codes[at] == code else self.rare

    def bits(self, a: int, b: int) -> float:
        if (x := self.memo.get((a, b))) is None:
            if len(self.memo) > 500_000:
                self.memo.clear()
            ha, hb = _is_han1(a), _is_han1(b)
            x = self._one(b if ha and hb else (_HAN if ha else a) << 21 | (_HAN if hb else b))
            if ha != hb:
                x = max(x, self._one(a if ha else b))
            self.memo[(a, b)] = x
        return x

    def worst(self, text: str, lo: int, hi: int) -> float:
        """Most bits of a pair in text[lo:hi], with blanks around the text."""
        c = [_fold1(ord(x)) for x in (text if lo >= 0 else " " + text[:hi])[max(0, lo) : hi - min(0, lo)]] + ([32] if hi > len(text) else [])
        return max((self.bits(a, b) for a, b in zip(c, c[1:]) if a > 127 or b > 127), default=0.0)

    def cost(self, text: str) -> tuple[float, int]:
        """Bits and pairs of a stretch in its setting, pairs of ASCII characters left out."""
        total, n, a = 0.0, 0, None
        for ch in text:
            b = _fold1(ord(ch))
            if a is not None and (a > 127 or b > 127):
                total += self.bits(a, b)
                n += 1
            a = b
        return total, n


def _fold1(c: int) -> int:
    if 48 <= c <= 57:
        return 48
    if c <= 32 or c in (0xA0, 0x3000) or 0x2000 <= c <= 0x200A:
        return 32
    return c


@lru_cache(None)
def _back(codec: str) -> dict[str, bytes]:
    """Character to bytes of an encoding; bytes it leaves undefined stand for C1 control characters."""
    out: dict[str, bytes] = {}
    if codec in ("gb18030", "big5", "cp932"):
        return out
    for b in range(128, 256):
        try:
            ch = bytes([b]).decode(codec)
        except UnicodeDecodeError:
            ch = chr(b)
        out.setdefault(ch, bytes([b]))
    return out


def _encode(text: str, codec: str) -> bytes | None:
    """Bytes of a text of any characters, or None."""
    table = _back(codec)
    if not table:
        try:
            return text.encode(codec)
        except UnicodeEncodeError:
            return None
    out = bytearray()
    for ch in text:
        if ch < "\x80":
            out += ch.encode()
        elif (b := table.get(ch)) is not None:
            out += b
        else:
            return None
    return bytes(out)


_MULTI = rb"(?:[\xc2-\xdf][\x80-\xbf]|[\xe1-\xef][\x80-\xbf]{2}|\xe0[\xa0-\xbf][\x80-\xbf]|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2})"
# in encodings of several bytes a character, an ASCII letter may have become its last byte
_UTF8 = re.compile(_MULTI + rb"(?:" + _MULTI + rb"|[\x40-\x7e])*")


@lru_cache(None)
def _shape(codec: str) -> re.Pattern | None:
    """Stretches of characters whose bytes in a single-byte encoding have the shape of UTF-8."""
    table = _back(codec)
    if not table:
        return None
    of = lambda lo, hi: "[" + "".join(re.escape(ch) for ch, b in table.items() if lo <= b[0] <= hi) + "]"
    tail = of(0x80, 0xBF)
    return re.compile(f"(?:{of(0xC2, 0xDF)}{tail}|{of(0xE0, 0xEF)}{tail}{{2}}|{of(0xF0, 0xF4)}{tail}{{3}})+")


@lru_cache(1)
def _any_shape() -> re.Pattern:
    """A place where a sequence of UTF-8 may have been read in one of the single-byte encodings."""
    return re.compile("|".join(p.pattern[:-1] for c in READ_AS if (p := _shape(c)) is not None))


def _utf8_runs(text: str, codec: str) -> list[tuple[int, int, str]]:
    """(start, end, repaired) of stretches whose bytes in `codec` are UTF-8 sequences."""
    found = []
    if (shape := _shape(codec)) is not None:
        for m in shape.finditer(text):
            try:
                found.append((m.start(), m.end(), _encode(m.group(), codec).decode("utf-8")))
            except UnicodeDecodeError:
                continue
        return found
    for part in _BEYOND.finditer(text):
        raw = part.group().encode(codec, "replace")
        ends = None
        for m in _UTF8.finditer(raw):
            if ends is None:
                c = np.frombuffer(part.group().encode("utf-32-le", "replace"), dtype=np.uint32)
                ends = np.concatenate([[0], np.cumsum(_widths(codec)[np.minimum(c, 0x10000)])])
            lo, hi = int(ends.searchsorted(m.start())), int(ends.searchsorted(m.end()))
            # it must not cut a character of the text in two
            if ends[lo] == m.start() and ends[hi] == m.end():
                found.append((part.start() + lo, part.start() + hi, m.group().decode("utf-8")))
    return found


_BEYOND = re.compile(r"[^\x00-\x7f]+")


@lru_cache(None)
def _widths(codec: str) -> np.ndarray:
    """Bytes of each character of the basic plane; the last entry stands for all others. What an encoding
    lacks is a question mark."""
    out = np.ones(0x10001, dtype=np.int64)
    for c in range(0x80, 0x10000):
        out[c] = len(chr(c).encode(codec, "replace"))
    out[0x10000] = len("\U0001f600".encode(codec, "replace"))
    return out


def _deeper(good: str) -> list[str]:
    """What a repaired stretch would be with further layers undone, each as a whole; every layer is
    shorter than the one before."""
    out, front = [good], [good]
    while front:
        nxt = []
        for g in front:
            for codec in READ_AS:
                shape = _shape(codec)
                if shape is not None and shape.search(g):
                    h = g
                    for lo, hi, x in reversed(_utf8_runs(g, codec)):
                        h = h[:lo] + x + h[hi:]
                    if h != g and h not in out:
                        out.append(h)
                        nxt.append(h)
        front = nxt
    return out


def _drop(r: Rarity, text: str, lo: int, hi: int, good: str) -> tuple[float, float, float]:
    """(bits a pair by which the cost drops when text[lo:hi] becomes `good`, in all, mean left)."""
    left, right = text[max(0, lo - 1) : lo] or " ", text[hi : hi + 1] or " "
    bad_bits, bad_n = r.cost(left + text[lo:hi] + right)
    good_bits, good_n = r.cost(left + good + right)
    mean = good_bits / max(1, good_n)
    drop = bad_bits / max(1, bad_n) - mean
    return drop, drop * bad_n, mean


def _undo_utf8(text: str, r: Rarity) -> str:
    """Sequences of UTF-8 that were read as something else, the best reading for each place."""
    offers: list[tuple[float, int, int, str]] = []
    han = _HANS.search(text) is not None
    shaped = _any_shape().search(text) is not None
    for codec in READ_AS:
        if codec not in _WIDE and not shaped:
            continue
        # single-byte encodings have no ideographs, the others are known by them
        if codec in _WIDE and not han and not _KANA.search(text):
            continue
        for lo, hi, first in _utf8_runs(text, codec):
            # by chance every other ideograph has such a shape: one of its pairs must be rare
            if codec in _WIDE and r.worst(text, lo - 1, hi + 1) <= ASK:
                continue
            best = max(((*_drop(r, text, lo, hi, g), g) for g in _deeper(first)), key=lambda x: x[0])
            if best[0] >= DROP and best[1] >= TOTAL:
                offers.append((best[0] * (hi - lo), lo, hi, best[3]))
    if not offers:
        return text
    offers.sort(key=lambda x: -x[0])
    taken: list[tuple[int, int, str]] = []
    for _, lo, hi, good in offers:
        if all(hi <= a or lo >= b for a, b, _ in taken):
            taken.append((lo, hi, good))
    out, at = [], 0
    for lo, hi, good in sorted(taken):
        out += [text[at:lo], good]
        at = hi
    return "".join([*out, text[at:]])


_WIDE = ("gb18030", "big5", "cp932")
# where U+FFFD, read as one of these, may stand: it has one of these characters in every alignment
_WIDE_LOST = re.compile("[锟拷嚙踝蕭]")
# one layer of C1 controls: letters that may stand before such signs in right text need a look around
_DOUBT = {"cp1252", "cp1250", "cp1251"}


@lru_cache(1)
def _losses():
    """Automaton of what U+FFFD and C1 controls become in up to `LOSS_LAYERS` rounds of UTF-8 read as a
    single-byte encoding; the value is (length, whether it counts only by its neighbours)."""
    import ahocorasick

    def read(t: str, codec: str) -> str:
        back = {b[0]: ch for ch, b in _back(codec).items()}
        return "".join(back.get(b, "�") if b > 127 else chr(b) for b in t.encode())

    a, sure, front = ahocorasick.Automaton(), set(), {"�", *map(chr, range(0x80, 0xA0))} - {"\x85"}
    doubt: set[str] = set()
    single = [c for c in READ_AS if c not in _WIDE]
    for layer in range(LOSS_LAYERS):
        nxt = set()
        for t in front:
            for codec in single:
                if layer and t in doubt and codec == "koi8-r":
                    continue
                x = read(t, codec)
                nxt.add(x)
                if not layer and t != "�" and (codec in _DOUBT or codec == "koi8-r"):
                    doubt.add(x)
                else:
                    sure.add(x)
        # beyond the first round only the replacement character: the rest is what the cost can tell
        front = nxt if not layer else {x for x in nxt if len(x) > 6}
        if layer == 0:
            front -= {x for x in doubt if x[0] == "б"}
    for x in doubt - sure:
        if x[0] != "б":  # KOI8-R: a letter before a line of a table
            a.add_word(x, (len(x), True))
    for x in sure:
        a.add_word(x, (len(x), False))
    a.make_automaton()
    return a


def _lost(text: str) -> bool:
    """Whether a stretch stands for U+FFFD or a C1 control, which nothing can be made of."""
    for end, (n, doubt) in _losses().iter(text):
        if not doubt:
            return True
        before, after = text[end - n : end - n + 1] if end >= n else " ", text[end + 1 : end + 2]
        # a capital after a small letter, or a sign of the end of words right before one
        if before.islower() or (text[end - n + 1] == "Â" and before.isspace() and after.isalpha()):
            return True
    if _WIDE_LOST.search(text):
        return any("�" in good for codec in _WIDE for _, _, good in _utf8_runs(text, codec))
    return False


_RUN = re.compile(r"[^\x00-\x7f]+(?:[a-zA-Z]*[^\x00-\x7f]+)*")
_HANS = re.compile(r"[\u3400-\u9fff\uac00-\ud7a3]")
_KANA = re.compile(r"[\u0370-\u04ff\u2500-\u257f\u3040-\u30ff\uff00-\uffef\ue000-\uf8ff]")
_EAST = re.compile(r"[\u3040-\u30ff\u3400-\u9fff\uac00-\ud7a3]")
# what a word may look like: letters of one script, apostrophes and hyphens between them, quotes around
_EDGE = "\"'“”„«»‘’‚‹›¡¿(),.;:!?…—–-"
_BREAK = re.compile("[—–…/,.:;!?\"“”„«»()]+")
_WORDS = [
    re.compile(f"[{up}]+(?:[’'-][{up}]+)*|[{up}]?[{low}]+(?:[’'-][{up}]?[{low}]+)*")
    for up, low in (("A-ZÀ-ÖØ-ÞŁŚŻŹĆŃĄĘŒŠŽ", "a-zß-öø-ÿłśżźćńąęœšž"), ("А-ЯЁ", "а-яё"))
]
_CASED = re.compile(r"[a-zß-öø-ÿа-яё][A-ZÀ-ÖØ-ÞА-ЯЁ]")


@lru_cache(200_000)
def _sane(word: str) -> bool:
    return all(any(w.fullmatch(x) for w in _WORDS) for x in (p.strip(_EDGE) for p in _BREAK.split(word)) if x)


@lru_cache(None)
def _stretch(codec: str) -> re.Pattern:
    return re.compile("[" + "".join(map(re.escape, _back(codec))) + "]{2,}")


def _parts(text: str, codec: str | None) -> list[tuple[int, str]]:
    """Where the words are, or the stretches of an encoding's own characters, and what they are."""
    found = _TOKEN.finditer(text) if codec is None else _stretch(codec).finditer(text)
    return [(m.start(), m.group()) for m in found]


def _reread(run: str, codec: str, true: str) -> str | None:
    raw = _encode(run, codec)
    try:
        good = raw.decode(true) if raw is not None else run
    except UnicodeDecodeError:
        return None
    return None if good == run or _SURE.search(good) else good


@lru_cache(200_000)
def _reread_word(run: str, codec: str, true: str) -> str | None:
    return _reread(run, codec, true)


@lru_cache(200_000)
def _readings(run: str) -> tuple[tuple[tuple[str, str], str, bool], ...]:
    """Sane words that a word may stand for, by the encodings it was read as and written in, and whether
    its script changes throughout."""
    far, sane, out = {c for c in run if c > "\x7f"}, _sane(run), []
    for codec in READ_AS[:-3]:
        if far <= _back(codec).keys():
            for true in WRITTEN_IN:
                if true != codec and true not in _EASTERN and (good := _reread(run, codec, true)) is not None:
                    foreign = _foreign(run, good)
                    if _sane(good) and (foreign if sane else re.search(r"\w\w", good)):
                        out.append(((codec, true), good, foreign))
    return tuple(out)


@lru_cache(200_000)
def _strange(run: str) -> bool:
    """Whether a word with a rare pair may be one of another encoding."""
    return not _HANS.search(run) and not _mixed(run) and (not _sane(run) or sum(c > "\x7f" for c in run) > 2) and any(c.isalpha() for c in run)


def _undo_legacy(text: str, r: Rarity, rare: list[tuple[int, int]]) -> str:
    """Text written in one legacy encoding and read as another: one pair of them for the whole text,
    chosen by the words that it makes sane; places that tell nothing alone follow it. `rare` has the
    words with rare pairs."""
    gains: dict[tuple[str, str], float] = {}
    for lo, hi in rare:
        run = text[lo:hi]
        if _strange(run):
            for pair, good, foreign in _readings(run):
                drop, total, mean = _drop(r, text, lo, hi, good)
                if mean <= 11 and drop >= (2 if foreign else 3):
                    gains[pair] = gains.get(pair, 0.0) + total
    # ideographs read in a single-byte encoding give long stretches of its upper half
    for m in _LONG.finditer(text):
        if _sane(m.group()) and (len(m.group()) < 6 or not any(lo < m.end() and hi > m.start() for lo, hi in rare)):
            continue
        for codec in READ_AS[:-3]:
            for at, run in _parts(m.group(), codec):
                if len(run) > 5 or (len(run) > 3 and not _sane(run)):
                    for true in _EASTERN:
                        good = _reread_word(run, codec, true)
                        if good is not None and len(_EAST.findall(good)) >= min(3, len(run) // 2):
                            drop, total, _ = _drop(r, text, m.start() + at, m.start() + at + len(run), good)
                            # what stands around says nothing about ideographs
                            bits, n = r.cost(good)
                            if bits <= 11 * n and drop >= 3:
                                gains[codec, true] = gains.get((codec, true), 0.0) + total
    best = max(gains.values(), default=0.0)
    chosen = next((p for p in ((c, t) for c in READ_AS for t in WRITTEN_IN) if gains.get(p) == best), None) if best > TOTAL else None
    if chosen is None:
        return _undo_eastern(text, r)
    out, at = [], 0
    for lo, run in _parts(text, chosen[0] if chosen[1] in _EASTERN else None):
        good = None if _mixed(run) else _reread(run, *chosen)
        if good is not None and _drop(r, text, lo, lo + len(run), good)[0] > 0:
            out += [text[at:lo], good]
            at = lo + len(run)
    return "".join([*out, text[at:]])


_EASTERN = ("gb18030", "big5", "cp932", "cp949", "euc_jp")
_LONG = re.compile(r"[^\x00-\x7f\u2e80-\uffff]{4,}")


_FAR_RUN = re.compile(r"[^\x00-\x7f\u2010-\u2027]{4,}")


def _undo_eastern(text: str, r: Rarity) -> str:
    """Text written in one encoding of several bytes a character and read as another: stretches of
    ideographs that cost far more than those they stand for."""
    runs = [(m.start(), m.group()) for m in _FAR_RUN.finditer(text) if _EAST.search(m.group())]
    told = [(lo, run) for lo, run in runs if (x := r.cost(run))[0] > 13 * x[1]]
    best, chosen = 3 * TOTAL, None
    for codec in _WIDE if told else ():
        for true in _EASTERN:
            gain = 0.0
            for lo, run in told:
                if true != codec and (good := _reread_word(run, codec, true)) is not None and len(_EAST.findall(good)) >= len(good) // 2:
                    drop, total, mean = _drop(r, text, lo, lo + len(run), good)
                    if mean <= 11 and drop >= 3:
                        gain += total
            if gain > best:
                best, chosen = gain, (codec, true)
    if chosen is None:
        return text
    out, at = [], 0
    for lo, run in runs:
        good = _reread(run, *chosen)
        if good is not None and _drop(r, text, lo, lo + len(run), good)[0] > 0:
            out += [text[at:lo], good]
            at = lo + len(run)
    return "".join([*out, text[at:]])


_CARRIED = [
    (re.compile(r"\x1b\$[@B][\x21-\x7e]+(?:\x1b\([BJ])?"), "iso2022_jp"),
    (re.compile(r"\x1b\$\)C[\x0e\x0f\x20-\x7e]+"), "iso2022_kr"),
    (re.compile(r"~\{(?:[\x21-\x7d][\x21-\x7e])+~\}"), "hz"),
    (re.compile(r"\+[A-Za-z0-9+/]{3,}-"), "utf-7"),
]


def _undo_carried(text: str, r: Rarity) -> str:
    """Other characters that ASCII carries: escapes of ISO 2022, HZ, UTF-7; the last only where it gives
    characters that are usual in the corpus."""
    for pattern, codec in _CARRIED:

        def one(m: re.Match) -> str:
            try:
                good = m.group().encode().decode(codec)
            except UnicodeDecodeError:
                return m.group()
            if good == m.group() or any(c <= "\x7f" for c in good) or _SURE.search(good):
                return m.group()
            bits, n = r.cost(f" {good} ")
            return good if codec != "utf-7" or bits <= 11 * n else m.group()

        text = pattern.sub(one, text)
    return text


def _mixed(run: str) -> bool:
    """Cyrillic letters in a word of Latin ones: look-alikes, which no encoding puts there."""
    return any("\u0400" <= c <= "\u04ff" for c in run) and any("a" <= c <= "z" for c in run.lower())


def _foreign(run: str, good: str) -> bool:
    """Words of Latin letters with accents throughout that stand for words of Cyrillic ones, or
    Cyrillic words with capitals inside that stand for right ones."""
    far = [c for c in run if c > "\x7f"]
    cyr = [c for c in good if "Ѐ" <= c <= "ӿ"]
    return len(cyr) >= 3 and len(cyr) == len(far) and not any("a" <= c.lower() <= "z" for c in run)


@lru_cache(1)
def _classes() -> tuple[np.ndarray, ...]:
    """For each character the single-byte encodings, as bits, in which it is the lead of a sequence of
    UTF-8 of 2, 3 or 4 bytes, or a byte that goes on with one; and whether it alone calls for a look."""
    lead2, lead3, lead4, tail = (np.zeros(1 << 16, dtype=np.uint32) for _ in range(4))
    for k, codec in enumerate(READ_AS):
        for ch, b in _back(codec).items():
            for table, lo, hi in ((lead2, 0xC2, 0xDF), (lead3, 0xE0, 0xEF), (lead4, 0xF0, 0xF4), (tail, 0x80, 0xBF)):
                if lo <= b[0] <= hi:
                    table[ord(ch)] |= np.uint32(1 << k)
    sure = np.zeros(1 << 16, dtype=bool)
    sure[[0xFFFD, *range(0x80, 0x85), *range(0x86, 0xA0), *map(ord, "锟拷嚙踝蕭")]] = True
    return lead2, lead3, lead4, tail, sure


class Repair:
    def __init__(self, rarity: Rarity):
        self.rarity = rarity
        self.memo: dict[str, str] = {}

    def token(self, t: str) -> str:
        if (got := self.memo.get(t)) is not None:
            return got
        out = t
        # every step takes a layer off some sequence, which shortens the text
        while (nxt := _undo_utf8(out, self.rarity)) != out:
            out = nxt
        if len(self.memo) > 200_000:
            self.memo.clear()
        self.memo[t] = out
        return out

    def places(self, texts: list[str]) -> list[tuple[list[tuple[int, int]], list[tuple[int, int]]]]:
        """For each text its words that call for a look (they have a rare pair, a sequence of the shape of
        UTF-8 read in a single-byte encoding, or what lost bytes become), and those with rare pairs."""
        raw = np.frombuffer("\n".join(texts).encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.int64)
        starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
        c = _fold(raw)
        c[raw == 0xAD] = 32
        gaps = np.concatenate([[-1], np.flatnonzero(raw <= 32), [len(raw)]])
        first = np.flatnonzero(self.rarity.all_bits(c) > ASK)
        rare = np.zeros(len(raw), dtype=bool)
        rare[first] = rare[np.minimum(first + 1, len(raw) - 1)] = True
        odd = rare | _shaped(raw) | _classes()[4][np.minimum(raw, 0xFFFF)]
        out = []
        for flags in (odd, rare):
            word = np.unique(np.searchsorted(gaps, np.flatnonzero(flags & (raw > 32))))
            lo, hi = gaps[word - 1] + 1, gaps[word]
            cut = np.searchsorted(lo, starts)
            out.append([list(zip((lo[a:b] - s).tolist(), (hi[a:b] - s).tolist())) for a, b, s in zip(cut[:-1], cut[1:], starts)])
        return list(zip(*out))

    def worst(self, t: str) -> float:
        worst, a = 0.0, 32
        for ch in t.replace("\xad", ""):
            b = _fold1(ord(ch))
            if a > 127 or b > 127:
                worst = max(worst, self.rarity.bits(a, b))
            a = b
        return max(worst, self.rarity.bits(a, 32)) if a > 127 else worst

    def text(self, text: str | None) -> tuple[bool, str | None]:
        """(whether it holds a wrongly decoded sequence, the text with what could be restored)."""
        return self.texts([text])[0]

    def texts(self, texts: list[str | None]) -> list[tuple[bool, str | None]]:
        """The same for many texts."""
        out: list[tuple[bool, str | None]] = [(False, t) for t in texts]
        for k, t in enumerate(texts):
            if t and ("\x1b" in t or "~{" in t or "+" in t) and (got := _undo_carried(t, self.rarity)) != t:
                out[k] = (True, got)
        some = [k for k, (_, t) in enumerate(out) if t and not t.isascii()]
        if some:
            for k, (odd, rare) in zip(some, self.places([out[k][1] for k in some])):
                if len(odd):
                    found, got = self._look(out[k][1], odd, rare)
                    out[k] = (out[k][0] or found, got)
        return out

    def _look(self, text: str, odd: list[tuple[int, int]], rare: list[tuple[int, int]]) -> tuple[bool, str]:
        out, at = [], 0
        for lo, hi in odd:
            if (good := self.token(text[lo:hi])) != text[lo:hi]:
                out += [text[at:lo], good]
                at = hi
        good = "".join([*out, text[at:]])
        if good != text:
            rare = self.places([good])[0][1]
        if rare:
            good = _undo_legacy(good, self.rarity, rare)
        return good != text or _SURE.search(text) is not None or _lost(text) or (good != text and _lost(good)), good


def corpus_counts(texts: DataFrame, text: str) -> DataFrame:
    """(code, n): pairs of neighbouring characters over all texts, without what may be garbled UTF-8."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes, n = count_pairs([t for t in b.column(0).to_pylist() if t], shapes=False)
            yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n)], ["code", "n"])

    # texts of ASCII characters only have no such pairs
    some = texts.where(F.col(text).rlike(r"[^\x00-\x7F]")).select(text)
    return some.mapInArrow(run, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n"))


def model(counts: DataFrame, scratch: Scratch) -> tuple[np.ndarray, np.ndarray]:
    """(codes, counts) of the pairs with at least `LEAST_SHARE` of all, which are at most 1 / LEAST_SHARE
    pairs and as many single ideographs, however large the corpus."""
    counts = scratch.save(counts)
    far = F.col("code") >= 1 << 21
    total = counts.agg(F.sum(F.when(far, F.col("n"))).alias("far"), F.sum(F.when(~far, F.col("n"))).alias("near")).first()
    kept = counts.where(F.col("n") >= LEAST_SHARE * F.when(far, F.lit(total["far"] or 0)).otherwise(F.lit(total["near"] or 0))).toArrow()
    scratch.drop(counts)
    return kept.column("code").to_numpy(), kept.column("n").to_numpy()


def repair_texts(spark: SparkSession, df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, garbled, restored): for each row whether it holds a wrongly decoded sequence, and its
    text with every such sequence restored that can be (lost bytes stay as they are).

    Counts are taken over all rows of `df`; only their shares matter. Null and empty texts are not garbled
    and come back unchanged; so do texts of unusual but right characters, and ASCII texts but for those
    that carry other characters (ISO 2022, HZ, UTF-7). Rows with equal keys are judged each by their own
    text.
    """
    shared = spark.sparkContext.broadcast(model(corpus_counts(df, text), Scratch(spark, "pairs")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repair = Repair(Rarity(shared.value))
        for b in batches:
            got = repair.texts(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([g[0] for g in got], pa.bool_()), pa.array([g[1] for g in got], pa.string())], [key, "garbled", "restored"])

    kind = dict(df.dtypes)[key]
    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, garbled boolean, restored string")
