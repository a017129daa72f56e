"""Evaluation texts leaking into training text.

The evaluation items are a stated query set; they are taken in blocks of at most `BLOCK` characters (a
single longer item is a block of its own), and each block's index is small enough to send to every
executor. For each block the corpus is read once:

1. each document's words are looked up in the items' n-grams, over a whole batch at a time. The task
   counts in how many documents each n-gram stands (summed by Spark), and keeps the hits of documents
   in which enough of them stand close together; both go into one written table;
2. seeds: of each few consecutive n-grams of an item, the one that is rarest in the corpus. A passage
   with at most one edit in ten always keeps a run of words that contains a seed, so rarity only
   chooses, it never drops. Items that share a seed with a document are compared by the n-grams they
   share along a diagonal band (a passage with so few edits must share a fixed number), and what
   passes that is aligned by Smith-Waterman along the band, which decides.

Texts are compared as words without case, accents, punctuation and markup; Chinese as characters.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkframe.scratch import Scratch

#: Characters of the items of one block: bounds what is sent to the executors and counted for it.
BLOCK = 4_000_000


@dataclass(frozen=True)
class Rule:
    """For a kind of text: n-gram length, n-grams in a row of which one is a seed, n-grams that so many
    in a row of an item must share along a band, width of the bands as a power of two (they overlap by
    half, which is more than so few edits shift), least matched words of an alignment that counts, and
    of one that counts if it holds an n-gram that is rare in the corpus: stock phrases in a row can
    match by chance for nearly as long as a passage, but have none. Whatever is rare, `passage` words
    (characters of the text, punctuation included) with `edits` count by definition."""

    n: int
    window: int
    share: int
    among: int
    band: int
    matched: int
    matched_rare: int
    passage: int
    edits: int


#: A passage of 30 words with 3 edits keeps a run of 7 words and 15 of its 27 4-grams.
WORDS = Rule(n=4, window=4, share=15, among=27, band=3, matched=28, matched_rare=20, passage=30, edits=3)
#: One of 60 characters (about 52 without punctuation) with 6 edits keeps a run of 7 and 18 5-grams.
CHARS = Rule(n=5, window=3, share=18, among=48, band=4, matched=42, matched_rare=38, passage=60, edits=6)

#: What an edit costs where a match is worth 1: stretches with over a quarter of edits lose.
COST = 3
#: Half the width of the band that alignments may use: far more than the edits of a passage shift.
HALF = 64
#: Words of an item that one alignment may go over.
TILE = 1 << 18
#: An n-gram is rare in up to so many documents, or in up to this share of them.
RARE_DOCS, RARE_SHARE = 10, 0.001
#: Least share of an alignment's words in the document that match.
CLOSE = 0.84

_MARKUP = re.compile(r"<[^<>\n]{1,80}>|&(?:[a-z]{2,8}|#\d{1,6});", re.IGNORECASE)
# what stands between letters comes first in the pattern, so that few places are looked at
_JOINT = re.compile(r"(?:[’'‘ʼ­](?<=\w[’'‘ʼ­])|[-‐‑](?<=\w[-‐‑])(?:[ \t]*\n)?)(?=\w)")
_TOKEN = re.compile(r"[㐀-䶿一-鿿豈-﫿]|[^\W_㐀-䶿一-鿿豈-﫿]+")
_PLAIN = re.compile(r"[^\W_]+")
_ACCENTS = re.compile("[\u0300-\u036f\u0483-\u0487\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff\ufe20-\ufe2f]+")
_HAN = re.compile(r"[㐀-䶿一-鿿]")
_MULT = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[str]:
    if not text:
        return []
    han = _HAN.search(text) is not None
    t = _JOINT.sub("", _MARKUP.sub("" if han else " ", text))
    if not t.isascii():
        plain = unicodedata.normalize("NFKD", t)
        t = _ACCENTS.sub("", plain)
        # compatibility forms of ideographs may come up only here
        han = han or _HAN.search(t) is not None
    return (_TOKEN if han else _PLAIN).findall(t.casefold())


def _grams(ids: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-grams of word numbers; 0 where a word is unknown (number 0)."""
    if len(ids) < n:
        return np.zeros(0, dtype=np.uint64)
    u, m = ids.astype(np.uint64), len(ids) - n + 1
    known = ids != 0
    h, ok = u[:m], known[:m]
    for k in range(n):
        if k:
            h, ok = h + u[k : m + k], ok & known[k : m + k]
        h = h * _MULT
        h = h ^ (h >> np.uint64(29))
    return np.where(ok, h | np.uint64(1), np.uint64(0))


class Index:
    """N-grams of a block of items, and which are seeds once the corpus has been counted."""

    def __init__(self, items: list[tuple[int, str]]):
        self.keys = [k for k, _ in items]
        toks = [words(t) for _, t in items]
        self.vocab: dict[str, int] = {}
        self.items = [np.array([self.vocab.setdefault(w, len(self.vocab) + 1) for w in t], dtype=np.int64) for t in toks]
        self.rules = [CHARS if 2 * sum(1 for w in t if _HAN.match(w)) > len(t) else WORDS for t in toks]
        self.spans = [_spans(t, w, r) for (_, t), w, r in zip(items, toks, self.rules)]
        self.by_rule = {}
        for rule in RULES:
            mine = [i for i, r in enumerate(self.rules) if r is rule]
            flat, starts = _joined([self.items[i] for i in mine])
            g = _grams(flat, rule.n)
            at = np.flatnonzero(g)
            grams, number = np.unique(g[at], return_inverse=True)
            own = np.searchsorted(starts, at, side="right") - 1
            places = np.stack([np.array(mine, dtype=np.int64)[own], at - starts[own]], axis=1) if len(at) else np.zeros((0, 2), np.int64)
            order = np.argsort(number, kind="stable")
            ends = np.concatenate([[0], np.cumsum(np.bincount(number, minlength=len(grams)))])
            # n-grams, where each one's places begin, places (item, position); seeds and rare ones
            self.by_rule[rule] = [grams, ends, places[order], np.zeros(len(grams), dtype=bool), np.zeros(len(grams), dtype=bool)]

    def ids(self, text: str | None) -> np.ndarray:
        get = self.vocab.get
        return np.array([get(w, 0) for w in words(text)], dtype=np.int64)

    def hits(self, ids: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
        """Positions in the document and numbers of the n-grams there that the items have."""
        grams = self.by_rule[rule][0]
        g = _grams(ids, rule.n)
        pos = np.flatnonzero(g)
        if not len(grams) or not len(pos):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        g = g[pos]
        at = np.minimum(np.searchsorted(grams, g), len(grams) - 1)
        same = grams[at] == g
        return pos[same], at[same]

    def look_up(self, texts: list[str | None], sums: dict[Rule, np.ndarray]) -> list[tuple[int, int, bytes, bytes, bytes]]:
        """Count the documents of each n-gram into `sums`; (document, rule, positions, n-grams, words) of
        those in which as many n-grams of the items as a passage shares stand within its length."""
        each = [self.ids(t) for t in texts]
        flat, starts = _joined(each)
        out = []
        for r, rule in enumerate(RULES):
            pos, at = self.hits(flat, rule)
            if not len(pos):
                continue
            doc = np.searchsorted(starts, pos, side="right") - 1
            n = len(sums[rule])
            sums[rule] += np.bincount(np.unique(doc * n + at) % n, minlength=n)
            if len(pos) < rule.share:
                continue
            k = rule.share - 1
            near = (pos[k:] - pos[: len(pos) - k] < rule.among + (1 << rule.band)) & (doc[k:] == doc[: len(doc) - k])
            for d in np.unique(doc[k:][near]).tolist():
                lo, hi = np.searchsorted(doc, d), np.searchsorted(doc, d, side="right")
                out.append((d, r, (pos[lo:hi] - starts[d]).astype(np.int32).tobytes(), at[lo:hi].astype(np.int32).tobytes(), each[d].astype(np.int32).tobytes()))
        return out

    def choose_seeds(self, counts: list[tuple[np.ndarray, np.ndarray]], docs: int) -> None:
        """Of each `window` n-grams in a row the rarest; the earliest of equally rare ones. `counts` holds
        n-grams and in how many documents they stand, `docs` is the number of documents of the corpus."""
        for rule, (number, n) in zip(RULES, counts):
            grams, _, _, seed, rare = self.by_rule[rule]
            if not len(grams):
                continue
            df = np.zeros(len(grams), dtype=np.int64)
            df[number] = n
            rare[:] = df <= max(RARE_DOCS, RARE_SHARE * docs)
            for i, ids in enumerate(self.items):
                if self.rules[i] is rule and len(ids) >= rule.n:
                    at = np.searchsorted(grams, _grams(ids, rule.n))
                    spans = np.lib.stride_tricks.sliding_window_view(at, min(rule.window, len(at)))
                    seed[spans[np.arange(len(spans)), df[spans].argmin(axis=1)]] = True

    def leaks(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item, matched words, first word, length in words in the document) of what has leaked."""
        ids = self.ids(text)
        return [x for rule in RULES for x in self.compare(rule, *self.hits(ids, rule), ids)]

    def compare(self, rule: Rule, pos: np.ndarray, at: np.ndarray, ids: np.ndarray) -> list[tuple[int, int, int, int]]:
        """The same from a document's hits."""
        return [x[1:] for x in self.compare_many(rule, [pos], [at], [ids])]

    def compare_many(self, rule: Rule, poss: list[np.ndarray], ats: list[np.ndarray], words: list[np.ndarray]) -> list[tuple[int, int, int, int, int]]:
        """(document, item, matched, first word, length) of several documents from their hits."""
        _, ends, flat, seed, rare = self.by_rule[rule]
        n_items = len(self.items)
        # as many documents at once as a table of documents by items stays small for
        many = max(1, min(256, (1 << 24) // max(1, n_items)))
        if len(poss) > many:
            return [
                (lo + d, *x) for lo in range(0, len(poss), many)
                for d, *x in self.compare_many(rule, poss[lo : lo + many], ats[lo : lo + many], words[lo : lo + many])
            ]
        pos, at = np.concatenate(poss), np.concatenate(ats)
        base = np.repeat(np.arange(len(poss)), [len(x) for x in poss]) * n_items
        # pairs of a document and an item that share a seed
        wanted = np.zeros(len(poss) * n_items, dtype=bool)
        first, of = at[seed[at]], base[seed[at]]
        wanted[np.repeat(of, ends[first + 1] - ends[first]) + flat[_ranges(ends[first], ends[first + 1]), 0]] = True
        n = ends[at + 1] - ends[at]
        rows = _ranges(ends[at], ends[at + 1])
        pair = np.repeat(base, n) + flat[rows, 0]
        # and so many n-grams at all
        total = np.where(wanted, np.bincount(pair, minlength=len(wanted)), 0)
        keep = np.flatnonzero(total[pair] >= rule.share)
        if not len(keep):
            return []
        pairs = np.flatnonzero(total >= rule.share)
        local, ipos = np.searchsorted(pairs, pair[keep]), flat[rows[keep], 1]
        hit = np.repeat(np.arange(len(at)), n)[keep]
        dpos, told = pos[hit], rare[at[hit]]
        longest, out, done = int(ipos.max()) + 1, [], set()
        diag = dpos - ipos + longest
        for shift in (0, 1 << (rule.band - 1)):
            band = (diag + shift) >> rule.band
            group = local * (int(band.max()) + 1) + band
            key = np.sort(group * longest + ipos)
            key = key[np.concatenate([[True], key[1:] != key[:-1]])]
            # so many of an item's n-grams within a passage's length, on one band
            if len(key) < rule.share:
                continue
            k = rule.share - 1
            lo, hi = key[: len(key) - k], key[k:]
            near = lo[hi - lo < rule.among] // longest
            for g in np.unique(near[near == hi[hi - lo < rule.among] // longest]).tolist():
                mine = np.flatnonzero(group == g)
                one = int(local[mine[0]])
                if one in done:
                    continue
                doc, item = divmod(int(pairs[one]), n_items)
                if found := self._align(rule, item, dpos[mine], ipos[mine], words[doc], dpos[(local == one) & told]):
                    done.add(one)
                    out.append((doc, item, *found))
        return out

    def _align(self, rule: Rule, i: int, dpos: np.ndarray, ipos: np.ndarray, ids: np.ndarray, told: np.ndarray) -> tuple[int, int, int] | None:
        """(matched, first word, length) if what item and document share along one band is a passage."""
        around, found = 40, None
        order = np.argsort(ipos, kind="stable")
        dpos, ipos = dpos[order], ipos[order]
        # very long regions are aligned in tiles that overlap by more than a passage
        for at in range(int(ipos[0]), int(ipos[-1]) + 1, TILE):
            one, end = np.searchsorted(ipos, at), np.searchsorted(ipos, at + TILE + 8 * rule.passage)
            if end - one >= rule.share and (place := self._align_tile(rule, i, dpos[one:end], ipos[one:end], ids, told, around)):
                found = max(found or place, place)
        return found

    def _align_tile(self, rule: Rule, i: int, dpos: np.ndarray, ipos: np.ndarray, ids: np.ndarray, told: np.ndarray, around: int) -> tuple[int, int, int] | None:
        ilo, ihi = max(0, int(ipos[0]) - around), int(ipos[-1]) + rule.n + around
        lo, hi = max(0, int(dpos.min()) - around), int(dpos.max()) + rule.n + around
        a, b = self.items[i][ilo:ihi], ids[lo:hi]
        shift = int(np.median(dpos - ipos)) - lo + ilo
        matched, start, length = smith_waterman(a, b, shift)
        if matched < rule.matched_rare and 3 * matched > 2 * rule.matched_rare:
            # edits close together may have cut a passage short: look on at a lower cost
            matched, start, length = smith_waterman(a, b, shift, COST - 1)
        if matched >= CLOSE * length and matched >= rule.matched_rare:
            inside = (told >= lo + start) & (told <= lo + start + length - rule.n)
            if matched >= rule.matched or inside.any():
                return matched, lo + start, length
        # frequency does not decide what is a passage by its length and edits
        place = passage(a, b, np.where(np.arange(ilo, ilo + len(a)) + self.spans[i][ilo:ihi] <= ilo + len(a), self.spans[i][ilo:ihi], 0), rule.edits, shift)
        if place is not None and place[0] >= rule.matched_rare:
            return place[0], lo + place[1], place[2]
        return None


RULES = (WORDS, CHARS)


def _joined(each: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Texts one after another with unknown words between, so that no n-gram spans two; where each begins."""
    gap = np.zeros(max(r.n for r in RULES), dtype=np.int64)
    starts = np.cumsum([0, *(len(x) + len(gap) for x in each)])[:-1] if each else np.zeros(0, np.int64)
    return (np.concatenate([y for x in each for y in (x, gap)]) if each else gap), starts


def _ranges(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The numbers lo..hi-1 of each pair, one after another."""
    n = hi - lo
    return np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())


def _spans(text: str, toks: list[str], rule: Rule) -> np.ndarray:
    """How many words from each on make up a passage; 0 where the item ends before. Characters are
    counted in the text as it stands, without spaces."""
    n = len(toks)
    if rule is WORDS:
        return np.where(np.arange(n) + rule.passage <= n, rule.passage, 0)
    shown = "".join(unicodedata.normalize("NFKD", _MARKUP.sub("", text)).casefold().split())
    at, k = [], 0
    for w in toks:
        k = max(shown.find(w, k), k)
        at.append(k)
        k += len(w)
    ends = np.searchsorted(np.array([*at, len(shown)]), np.array(at, dtype=np.int64) + rule.passage)
    return np.where(ends <= n, ends - np.arange(n), 0)


def passage(a: np.ndarray, b: np.ndarray, spans: np.ndarray, edits: int, shift: int | None = None) -> tuple[int, int, int] | None:
    """(matched at least, start in b, length in b) of the stretch of `a` among those of `spans[s]` words
    from s on that stands in `b` with fewest edits, if these are at most `edits`. With `shift`, a stretch
    from s on is looked for around s + shift only, so that long texts cost no more than their length."""
    every = np.flatnonzero(spans)
    if not len(every) or not len(b):
        return None
    best = None
    tile = len(every) if shift is None else 256
    for t in range(0, len(every), tile):
        starts = every[t : t + tile]
        lo = 0 if shift is None else max(0, int(starts[0]) + shift - HALF)
        part = b[lo : len(b) if shift is None else max(0, int(starts[-1]) + int(spans.max()) + shift + HALF)]
        if not len(part):
            continue
        cols = np.arange(len(part) + 1)
        cost = np.zeros((len(starts), len(part) + 1), dtype=np.int64)
        began = np.tile(cols, (len(starts), 1))
        for step in range(int(spans[starts].max())):
            x = a[np.minimum(starts + step, len(a) - 1)]
            diag = cost[:, :-1] + (part[None, :] != x[:, None])
            up = cost + 1
            s, st = up.copy(), began.copy()
            use = diag <= up[:, 1:]
            s[:, 1:][use], st[:, 1:][use] = diag[use], began[:, :-1][use]
            lead = s - cols
            low = np.minimum.accumulate(lead, axis=1)
            src = np.maximum.accumulate(np.where(lead == low, cols, 0), axis=1)
            cost, began = low + cols, np.take_along_axis(st, src, axis=1)
            for r in np.flatnonzero(spans[starts] == step + 1):
                k = int(cost[r].argmin())
                if cost[r, k] <= edits and (best is None or cost[r, k] < best[0]):
                    best = (int(cost[r, k]), step + 1, lo + int(began[r, k]), lo + k)
    return None if best is None else (best[1] - best[0], best[2], best[3] - best[2])


def smith_waterman(a: np.ndarray, b: np.ndarray, shift: int | None = None, cost: int = COST) -> tuple[int, int, int]:
    """(matched, start in b, length in b) of the best local alignment of two word sequences.

    A match is worth 1; a word replaced, dropped or added costs `cost`. With `shift`, word i of `a` may
    stand only within `HALF` places of i + shift. Rows are computed as wholes; the running maximum
    resolves gaps within a row. Words unknown to the items (0) match nothing. Every cell carries how many
    matches its alignment has and where in b it starts.
    """
    n, m = len(a), len(b)
    if not m or not n:
        return 0, 0, 0
    # cell c of row i ends at word i + first + c of b; b is widened by words that match nothing
    first, width = (1 - n, n + m) if shift is None else (shift - HALF, 2 * HALF + 1)
    left = max(0, -first)
    wide = np.concatenate([np.full(left, -1), b, np.full(max(0, n + first + width - m), -1)])
    # a cell holds its score, matches and start in one number, so that one comparison orders all three
    one, match = np.int64(1) << 43, (np.int64(1) << 43) + (np.int64(1) << 23)
    steps = np.arange(width) * (one * cost)
    fresh = np.arange(width) + left + first
    cell, top, end = fresh.copy(), np.int64(0), 0
    up = np.zeros(width, np.int64)
    for i in range(n):
        at = i + first
        fresh = fresh + 1
        if at >= m or at + width <= 0:
            cell = fresh.copy()
            continue
        same = wide[left + at : left + at + width] == a[i]
        # the word of a is dropped: the row before, one place on
        up[:-1] = cell[1:]
        new = np.maximum(np.where(same, cell + match, cell - cost * one), up - cost * one)
        new = np.maximum(new, fresh)
        # words added in b: from the best cell to the left, at `cost` for each step
        new = np.maximum(np.maximum.accumulate(new + steps) - steps, fresh)
        # a cell without a score begins anew
        cell = np.where(new < one, fresh, new)
        k = int(cell.argmax())
        if cell[k] >> 43 > top >> 43:
            top, end = cell[k], at + k + 1
    if top < one:
        return 0, 0, 0
    begin = int(top & ((1 << 23) - 1)) - left
    return int((top >> 23) & ((1 << 20) - 1)), begin, end - begin


def find_leaks(spark: SparkSession, docs: DataFrame, doc_key: str, text: str, items: DataFrame, item_key: str, item_text: str) -> DataFrame:
    """(doc_key, item_key, matched, first_word, n_words): documents that repeat a passage of an item.

    Documents and items are read whole, whatever their length. Null and empty texts leak nothing, nor do
    items shorter than a passage. Items of equal text each get their rows; repeated documents too. No
    items: no rows.
    """
    sc, scratch = spark.sparkContext, Scratch(spark, "leaks")
    kinds = dict(docs.dtypes)[doc_key], dict(items.dtypes)[item_key]
    schema = f"`{doc_key}` {kinds[0]}, `{item_key}` {kinds[1]}, matched int, first_word int, n_words int"
    keyed = items.where(f"`{item_key}` is not null and `{item_text}` is not null").select(item_key, item_text)
    size = keyed.agg(F.sum(F.length(item_text))).first()[0] or 0
    n_blocks = -(-size // BLOCK)
    out = None
    for block in range(n_blocks):
        # a block of the query set, of bounded size
        part = keyed if n_blocks == 1 else keyed.where(F.pmod(F.xxhash64(item_key), F.lit(n_blocks)) == block)
        got = part.toArrow()
        index = Index(list(zip(got.column(0).to_pylist(), got.column(1).to_pylist())))
        shared = sc.broadcast(index)

        def look_up(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ix = shared.value
            sums, docs = {r: np.zeros(len(ix.by_rule[r][0]), np.int64) for r in RULES}, 0
            for b in batches:
                docs += b.num_rows
                found = ix.look_up(b.column(1).to_pylist(), sums)
                key = b.column(0).take(pa.array([x[0] for x in found], pa.int64()))
                cols = list(zip(*found)) if found else [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(len(found), pa.int64()), pa.nulls(len(found), pa.int64()), key, pa.array(cols[1], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[2:])],
                    names,
                )
                none = lambda n: [pa.nulls(n, b.schema.field(0).type)]
                rest = lambda n: [pa.nulls(n, pa.binary())] * 3
            if not docs:
                return
            yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int64()), pa.array([docs], pa.int64()), *none(1), pa.array([-1], pa.int32()), *rest(1)], names)
            for r, rule in enumerate(RULES):
                nz = np.flatnonzero(sums[rule])
                yield pa.RecordBatch.from_arrays([pa.array(nz), pa.array(sums[rule][nz]), *none(len(nz)), pa.array(np.full(len(nz), r, np.int32)), *rest(len(nz))], names)

        names = ["gram", "docs", "key", "rule", "places", "grams", "words"]
        seen = scratch.save(docs.select(doc_key, text).mapInArrow(look_up, f"gram bigint, docs bigint, key {kinds[0]}, rule int, places binary, grams binary, words binary"))
        # one row for each n-gram of the block at most
        counted = seen.where("gram is not null").groupBy("rule", "gram").agg(F.sum("docs").alias("docs")).toArrow()
        rule, gram, n = (counted.column(c).to_numpy() for c in ("rule", "gram", "docs"))
        index.choose_seeds([(gram[rule == r], n[rule == r]) for r in range(len(RULES))], int(n[rule == -1].sum()))
        index.vocab = {}
        seeded = sc.broadcast(index)

        def compare(batches: Iterator[pa.RecordBatch], shared=seeded) -> Iterator[pa.RecordBatch]:
            ix, whole = shared.value, lambda x: np.frombuffer(x, dtype=np.int32).astype(np.int64)
            for b in batches:
                at, found = [], []
                rules = b.column(1).to_numpy()
                for r, rule in enumerate(RULES):
                    mine = np.flatnonzero(rules == r)
                    if len(mine):
                        parts = [[whole(x) for x in b.column(c).take(pa.array(mine)).to_pylist()] for c in (2, 3, 4)]
                        for d, i, *x in ix.compare_many(rule, *parts):
                            at.append(int(mine[d]))
                            found.append((ix.keys[i], *x))
                cols = list(zip(*found)) if found else [[], [], [], []]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(at, pa.int64())), pa.array(cols[0], pa.int64() if kinds[1] == "bigint" else None), *(pa.array(c, pa.int32()) for c in cols[1:])],
                    [doc_key, item_key, "matched", "first_word", "n_words"],
                )

        # a small table, but each row of it is work: spread it over as many tasks as a shuffle has
        spread = seen.where("gram is null").select("key", "rule", "places", "grams", "words").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
        leaked = spread.mapInArrow(compare, schema)
        out = leaked if out is None else out.unionByName(leaked)
    return out if out is not None else spark.createDataFrame([], schema)
