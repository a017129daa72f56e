"""Visually identical text with different characters, brought to one form.

1. Characters that show nothing are deleted; kinds of space and hyphen, widths of letters and digits,
   ligatures, radicals and compatibility ideographs are folded, and accents composed. What a reader
   sees as different (letter case, accents, punctuation, superscripts, circled digits) stays.
2. Letters of one look are a class with a member in each script. The words of a text become lattices
   of these members, and Viterbi search finds the reading with the fewest changes of script, of those
   one that begins in the script of the words around, of those the likeliest: pairs of letters of one
   script score by their shares in the corpus, and a pair never seen costs most.

The lattice depends on the looks alone, never on which member the text had, and different looks never
share a member. So texts get equal forms if, and only if, they look the same.
"""

from __future__ import annotations

import hashlib
import math
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LATIN, CYRILLIC, GREEK = 0, 1, 2
# Letters of one look, Latin, Cyrillic, Greek ("-": none).
LOOKS = """
aаα eе- oоο cс- pрρ xх- yу- iі- jјϳ sѕ- hһ- dԁ- qԛ- wԝ- vѵν lӏ-
AАΑ BВΒ CС- EЕΕ HНΗ IІΙ JЈϿ KКΚ MМΜ N-Ν OОΟ PРΡ SЅ- TТΤ XХΧ YУΥ Z-Ζ QԚ- WԜ-
""".split()
# Further characters of the look of a Latin letter (small capitals, Armenian, Cherokee, Coptic, Lisu).
ALSO = dict(
    x.split("=")
    for x in """
    ɡ=g ɑ=a ⅼ=l Ү=Y ᴄ=c ᴏ=o ꜱ=s ᴠ=v ᴡ=w ᴢ=z
    օ=o ո=n ս=u հ=h յ=j զ=q Ս=U Օ=O
    Ꭺ=A Ᏼ=B Ꮯ=C Ꭰ=D Ꭼ=E Ꮐ=G Ꮋ=H Ꭻ=J Ꮶ=K Ꮮ=L Ꮇ=M Ꮲ=P Ꭱ=R Ꮪ=S Ꭲ=T Ꮩ=V Ꮃ=W Ꮓ=Z
    ⲟ=o ⲣ=p ⲥ=c Ⲏ=H Ⲓ=I Ⲕ=K Ⲙ=M Ⲛ=N Ⲟ=O Ⲣ=P Ⲥ=C Ⲧ=T Ⲩ=Y Ⲭ=X
    ꓐ=B ꓑ=P ꓓ=D ꓔ=T ꓖ=G ꓗ=K ꓙ=J ꓚ=C ꓜ=Z ꓝ=F ꓟ=M ꓠ=N ꓡ=L ꓢ=S ꓣ=R ꓦ=V ꓧ=H ꓪ=W ꓫ=X ꓬ=Y ꓮ=A ꓰ=E ꓲ=I ꓳ=O ꓴ=U
    """.split()
)
#: Share of the letter pairs that one never seen is taken to have, whatever the size of the corpus: 22 bits.
UNSEEN_SHARE = 2.0**-22
UNSEEN = 22.0

_NOTHING = "\x00-\x08\x0e-\x1f\x7f-\x84\x86-\x9f\xad͏؜ᅟᅠ឴឵᠋-᠏​-‏‪-‮⁠-⁯ㅤ︀-️﻿ﾠ￰-￻\U000e0000-\U000e0fff"
_HYPHENS = "‐‑﹣－"
_SPACES = "\t\x0b\x0c\xa0  -   　"
_DELETE = re.compile(f"[{_NOTHING}]+")
# anything that may need work: not plain ASCII, and not a letter, sign or ideograph that is its own form
_CLEAN = re.compile("[\\n -~¡-¬®-´¶-ÿŁłŚśŻżŹźĆćŃńĄąĘęŒœŠšŽž‘-„†-•…‹›–—€、-】㐀-䶿一-鿿！（），．：；？]*")
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ɏɐ-ʯͰ-ϿЀ-ԯԱ-ևḀ-῿̀-ͯ" + "".join(ALSO) + "]+")
_FAR = re.compile("[ɐ-ʯͰ-ԯԱ-ևᴀ-ᶿⱠ-Ɀꓸ-꓿" + "".join(ALSO) + "]")


@lru_cache(1)
def _folds() -> dict[int, str | None]:
    """Widths, ligatures and compatibility forms of letters, digits, hyphens and ideographs; not those
    that a reader sees as raised, lowered, circled or as a fraction, and no punctuation."""
    out: dict[int, str | None] = {}
    for c in range(0xA0, 0x30000):
        if 0xAC00 <= c <= 0xD7A3 or 0xD800 <= c <= 0xF8FF:
            continue
        ch = chr(c)
        d = unicodedata.decomposition(ch)
        if not d:
            continue
        kind = d.split()[0] if d[0] == "<" else ""
        if kind in ("<super>", "<sub>", "<circle>", "<fraction>", "<square>"):
            continue
        to = unicodedata.normalize("NFKC", ch)
        if kind and not all(unicodedata.category(x)[0] in "LN" or x == "-" for x in to):
            continue
        if kind == "<compat>" and unicodedata.category(ch)[0] == "N" and not to.isalpha():
            continue
        if to != ch:
            out[c] = to
    for c in _HYPHENS:
        out[ord(c)] = "-"
    for lo, hi in re.findall(r"(.)(?:-(.))?", _SPACES):
        for c in range(ord(lo), ord(hi or lo) + 1):
            out[c] = " "
    return out


@lru_cache(1)
def _classes() -> tuple[dict[str, tuple[str, ...]], dict[str, int]]:
    """Letter to the members of its class by script, and script of every letter."""
    members: dict[str, tuple[str, ...]] = {}
    for row in LOOKS:
        for ch in row:
            if ch != "-":
                members[ch] = tuple(row)
    for ch, base in ALSO.items():
        members[ch] = members.get(base, (base, "-", "-"))
        members.setdefault(base, members[ch])
    return members, {}


def _script(ch: str) -> int:
    c = ord(ch)
    return GREEK if 0x370 <= c <= 0x3FF or 0x1F00 <= c <= 0x1FFF else CYRILLIC if 0x400 <= c <= 0x52F else LATIN


_SIZE = 0x530


def letter_pairs(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(codes, counts) of neighbouring letters of one script, accents apart."""
    flat = unicodedata.normalize("NFD", "\n".join(texts))
    c = np.frombuffer(flat.encode("utf-32-le", "replace"), dtype=np.uint32)
    c = c[(c < 0x300) | (c > 0x36F)]
    letter = np.zeros(_SIZE, dtype=bool)
    for k in range(65, _SIZE):
        letter[k] = chr(k).isalpha()
    c = np.where(c < _SIZE, c, 0).astype(np.int64)
    ok = letter[c[:-1]] & letter[c[1:]] if len(c) > 1 else np.zeros(0, bool)
    codes = c[:-1][ok] * _SIZE + c[1:][ok] if len(c) > 1 else np.zeros(0, np.int64)
    n = np.bincount(codes)
    at = np.flatnonzero(n)
    return at, n[at]


class Normalizer:
    """`pairs`: counts of letter pairs over the corpus."""

    def __init__(self, pairs: dict[int, int]):
        self.members, _ = _classes()
        self.folds = _folds()
        total = max(1, sum(pairs.values()))
        self.bits = {k: -math.log2(n / total + UNSEEN_SHARE) for k, n in pairs.items()}
        self.memo: dict[tuple[str, int], str] = {}
        self.kinds: dict[str, int] = {}

    def _look(self, word: str) -> str:
        """The word with the first member of each class in place: its look."""
        m = self.members
        return "".join((next(x for x in m[c] if x != "-") if c in m else c) for c in word)

    def _kind(self, look: str) -> int:
        """The script that the letters without look-alikes in other scripts name; -1 if none or several."""
        if (k := self.kinds.get(look)) is None:
            named = set()
            for c in look:
                if c.isalpha() and c != "μ":  # the micro sign, in any script
                    row = self.members.get(c)
                    if row is None:
                        named.add(_script(c))
            k = self.kinds[look] = named.pop() if len(named) == 1 else -1
            if len(self.kinds) > 300_000:
                self.kinds.clear()
        return k

    def _viterbi(self, look: str, lean: int) -> str:
        """Likeliest members for a look; `lean` is the script of the words around."""
        if (got := self.memo.get((look, lean))) is not None:
            return got
        options = []
        for c in look:
            row = self.members.get(c)
            options.append(None if not c.isalpha() else {s: x for s, x in enumerate(row) if x != "-"} if row else {_script(c): c})
        got = self._search(look, options, lean)
        out = unicodedata.normalize("NFC", got)
        if len(self.memo) > 300_000:
            self.memo.clear()
        self.memo[(look, lean)] = out
        return out

    def _pair(self, a: str, b: str) -> float:
        return self.bits.get(ord(a) * _SIZE + ord(b), UNSEEN) if max(ord(a), ord(b)) < _SIZE else UNSEEN

    def _search(self, look: str, options: list, lean: int) -> str:
        """The best path through the lattice; a path costs (changes of script, not begun in `lean`, bits)."""
        best: dict[int, tuple[int, int, float]] = {}
        steps: list[dict[int, int]] = []
        last: dict[int, str] = {}
        for o in options:
            if o is None:
                steps.append({})
                continue
            if not best:
                best, back = {s: (0, int(s != lean), 0.0) for s in o}, {s: s for s in o}
            else:
                new, back = {}, {}
                for s, x in o.items():
                    new[s], back[s] = min(((v[0] + (p != s), v[1], v[2] + (self._pair(last[p], x) if p == s else 0.0)), p) for p, v in best.items())
                best = new
            last = o
            steps.append(back)
        if not best:
            return look
        s = min(best, key=lambda s: (best[s], s))
        out = []
        for c, o, back in zip(reversed(look), reversed(options), reversed(steps)):
            if o is None:
                out.append(c)
            else:
                out.append(o[s])
                s = back[s]
        return "".join(reversed(out))

    def form(self, text: str | None) -> str | None:
        if text is None or _CLEAN.fullmatch(text):
            return text
        t = _DELETE.sub("", text).translate(self.folds)
        t = _DELETE.sub("", t)
        if not _FAR.search(t):
            return unicodedata.normalize("NFC", t)
        t = unicodedata.normalize("NFD", t)
        words = [(m.start(), m.end(), self._look(m.group())) for m in _LETTERS.finditer(t)]
        kinds = [self._kind(w) for _, _, w in words]
        tally = [kinds.count(s) for s in (LATIN, CYRILLIC, GREEK)]
        main = max((LATIN, CYRILLIC, GREEK), key=lambda s: (tally[s], -s))
        # the nearest named word before, else the one after, else the text's main script
        lean, out, at = main, [], 0
        after = [main] * (len(words) + 1)
        for i in range(len(words) - 1, -1, -1):
            after[i] = kinds[i] if kinds[i] >= 0 else after[i + 1]
        seen = False
        for i, (lo, hi, look) in enumerate(words):
            if kinds[i] >= 0:
                lean, seen = kinds[i], True
            use = lean if seen else after[i]
            out += [t[at:lo], self._viterbi(look, use)]
            at = hi
        return unicodedata.normalize("NFC", "".join([*out, t[at:]]))


def pair_counts(texts: DataFrame, text: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes, n = letter_pairs([t for t in b.column(0).to_pylist() if t])
            yield pa.RecordBatch.from_arrays([pa.array(codes, pa.int64()), pa.array(n, pa.int64())], ["code", "n"])

    return texts.select(text).mapInArrow(run, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n"))


def normalize_texts(spark: SparkSession, df: DataFrame, text: str, digest_only: bool = False) -> DataFrame:
    """`df` with `canonical`: the one form of each text, or with `digest_only` its 16-byte digest.

    Counts of letter pairs are taken over all rows of `df`: at most the square of the alphabets'
    size, whatever the corpus. A null text stays null, an empty one empty; text of characters that
    show nothing becomes empty. Forms are stable: the form of a form is itself. Other columns pass
    through; one named `canonical` is replaced.
    """
    df = df.drop("canonical")
    shared = spark.sparkContext.broadcast({r.code: r.n for r in pair_counts(df, text).collect()})
    at = df.columns.index(text)
    fields = ", ".join(f"`{c}` {t}" for c, t in df.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        norm = Normalizer(shared.value)
        for b in batches:
            forms = [norm.form(t) for t in b.column(at).to_pylist()]
            if digest_only:
                col = pa.array([None if x is None else hashlib.blake2b(x.encode("utf-8", "replace"), digest_size=16).digest() for x in forms], pa.binary())
            else:
                col = pa.array(forms, pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, col], [*b.schema.names, "canonical"])

    return df.mapInArrow(run, f"{fields}, canonical {'binary' if digest_only else 'string'}")
