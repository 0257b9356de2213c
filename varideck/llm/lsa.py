"""Benchmark decontamination by latent semantic retrieval.

1. Texts become lists of 32-bit word hashes (lower case, without punctuation), stored once.
2. Document frequencies over all passages of PASSAGE words, in 2**16 hash buckets, give the weights.
3. A randomised SVD of the TF-IDF matrix: its columns are the benchmark's terms, its rows the corpus passages with enough weight on
   those terms and the items, all at their natural weight. Each task adds up its part of A'(A Q) for the basis Q so far, a random one at
   first; the sum of these small matrices, orthonormalised, is the next basis, so each of STEPS passes is a power step. The basis of
   `rank` columns is the latent space: words that occur in the same passages come to lie in the same directions.
4. Overlapping windows of all documents and pieces of PASSAGE words of the items are projected into it; pairs with a cosine of at least
   `similar` there are candidates.
5. So are all places that the decision below could accept, whatever their cosine, as a reduced space loses some. Of L words of which n
   have to be found, any L - n + 1 hold one that is found: each item is looked up by so many of its rarest words (for a copy) and of its
   answer's (for a paraphrase), and a place stays if the words around it hold enough of the item's.
6. The longest common subsequence of the item and the words around a candidate decides: enough of the item in order is a copy, less is a
   paraphrase if the item's answer (its last sentence) is there too. Step 5 finds every stretch of at most the item's words and STRIDE
   more that passes, for items of any length; step 4 adds longer ones, whose words stand further apart. Short items of common words are
   found in long stretches by chance, so for a paraphrase these have to hold APART more of the item.

The benchmark is worked on in groups of at most `group` rows with a space each, and `groups` of them in one pass over the documents, so
what is broadcast is bounded whatever the benchmark's size. Rows of both tables have a number of their own: groups are cut and results
are put together by it, never by the ids.

Defined cases: null and empty texts, and texts without words, are clean; items without words match nothing; texts are searched whole;
each row of the documents gives one row, whatever ids repeat; an item found several times is named once; a document with a null id is
kept, an item with a null id is searched too and stands as a null, last in the list; an empty benchmark or corpus gives clean or no
rows; other columns are dropped, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, MARKS, hash_words, map_batches, slices, stored, text_bytes, words_of

PASSAGE = 48
STRIDE = 24
BUCKETS = 1 << 16
SENTENCE = (46, 33, 63)
STEPS = 2
#: So much more of an item has to be found where its words stand further apart.
APART = 0.1
ROW = "_row_number"


def word_hashes(column: pa.Array) -> list[np.ndarray]:
    """The uint32 hash of each word of each text."""
    raw, offsets = text_bytes(column)
    raw = LOWER[raw]
    starts, ends, first = words_of(raw, offsets, MARKS)
    hashes = (hash_words(raw, starts, ends, 31) >> np.uint64(32)).astype(np.uint32)
    return [hashes[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]


def stored_words(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, words (binary, uint32 hashes) and the row's number, ROW."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for part in slices(batch.column(1)) for x in word_hashes(part)], pa.binary())], [key, "words"])

        return work

    kind = docs.schema[key].dataType.simpleString()
    return stored(map_batches(docs.select(key, text), make, f"`{key}` {kind}, words binary").withColumn(ROW, F.monotonically_increasing_id()), "words")


def batch_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All word hashes of a batch and where each document begins among them."""
    raw, offsets = text_bytes(column)
    return np.frombuffer(raw.tobytes(), np.uint32), offsets // 4


def document_frequencies(words: DataFrame) -> tuple[np.ndarray, int]:
    """The number of passages with each bucket, and the number of passages; summed up in the tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, total = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            hashes, at = batch_words(batch.column(0))
            if not len(hashes):
                continue
            sizes = np.diff(at)
            passages = -(-sizes // PASSAGE)
            place = np.arange(len(hashes)) - np.repeat(at[:-1], sizes)
            number = np.repeat(np.cumsum(passages) - passages, sizes) + place // PASSAGE
            # Passage and bucket fit 32 bits, which sort faster, for 2**16 passages at a time.
            for part in np.split(np.arange(len(hashes)), np.searchsorted(number, np.arange(BUCKETS, int(number[-1]) + 1, BUCKETS))):
                a, b = part[0], part[-1] + 1
                pairs = np.sort(((number[a:b] % BUCKETS).astype(np.uint32) << np.uint32(16)) | (hashes[a:b] & np.uint32(BUCKETS - 1)))
                pairs = pairs[np.r_[True, pairs[1:] != pairs[:-1]]]
                counts += np.bincount(pairs & np.uint32(BUCKETS - 1), minlength=BUCKETS)
            total += int(passages.sum())
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[np.arange(BUCKETS), BUCKETS].astype(np.int32)), pa.array(np.r_[counts, total])], ["bucket", "n"])

    rows = words.select("words").mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()  # BUCKETS + 1 rows
    out = np.zeros(BUCKETS + 1, np.int64)
    for r in rows:
        out[r.bucket] = r.n
    return out[:-1], int(out[-1])


@dataclass
class Space:
    """What tasks need of a group of items; its size depends on the group alone."""

    terms: np.ndarray  # sorted hashes of the items' words
    weights: np.ndarray  # of each term
    idf: np.ndarray  # of each bucket
    items: list[np.ndarray]
    answers: list[np.ndarray]
    ids: list[int]
    basis: np.ndarray  # terms x rank
    latent: np.ndarray  # pieces x rank, unit length
    piece_of: np.ndarray  # the item of each piece
    cosine: float

    def term_numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word's term, or -1: by a table over the upper bits, and by search where two terms share them."""
        if not hasattr(self, "_slots"):
            upper = (self.terms >> np.uint32(12)).astype(np.int64)
            self._slots = np.full(1 << 20, -1, np.int32)
            self._slots[upper] = np.arange(len(self.terms))
            self._shared = np.zeros(1 << 20, bool)
            self._shared[upper[1:][upper[1:] == upper[:-1]]] = True
            self._square = (self.idf**2).astype(np.float64)
        upper = hashes >> np.uint32(12)
        term = self._slots[upper]
        odd = np.flatnonzero(self._shared[upper])
        term[odd] = np.minimum(np.searchsorted(self.terms, hashes[odd]), len(self.terms) - 1)
        term[self.terms[term] != hashes] = -1
        return term

    def windows(self, hashes: np.ndarray, at: np.ndarray, stride: int) -> tuple[np.ndarray, ...]:
        """Windows whose weight on the terms lets them reach the cosine: start, end, squared norm; and each word's term or -1."""
        sizes = np.diff(at)
        counts = np.where(sizes > PASSAGE, -(-(sizes - PASSAGE) // stride) + 1, (sizes > 0).astype(np.int64))
        doc = np.repeat(np.arange(len(sizes)), counts)
        start = at[:-1][doc] + (np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)) * stride
        end = np.minimum(start + PASSAGE, at[1:][doc])
        term = self.term_numbers(hashes)
        square = self._square[hashes & np.uint32(BUCKETS - 1)]
        total, inside = np.zeros(len(hashes) + 1), np.zeros(len(hashes) + 1)
        np.cumsum(square, out=total[1:])
        np.cumsum(np.where(term >= 0, square, 0), out=inside[1:])
        norm, on_terms = total[end] - total[start], inside[end] - inside[start]
        keep = (on_terms >= self.cosine**2 * norm) & (norm > 0)
        return start[keep], end[keep], norm[keep], term

    def rows(self, term: np.ndarray, start: np.ndarray, end: np.ndarray, matrix: np.ndarray) -> np.ndarray:
        """The TF-IDF rows of windows times matrix."""
        out = np.zeros((len(start), matrix.shape[1]), np.float32)
        scaled = (matrix * self.weights[:, None]).astype(np.float32)
        for offset in range(PASSAGE):
            here = start + offset
            fits = np.flatnonzero(here < end)
            fits = fits[term[here[fits]] >= 0]
            out[fits] += scaled[term[here[fits]]]
        return out


def subsequence(item: np.ndarray, words: np.ndarray) -> int:
    """Length of the longest common subsequence, one machine-number step a word (bits stand for the item's words)."""
    spots: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        spots[w] = spots.get(w, 0) | 1 << i
    full = (1 << len(item)) - 1
    row = full
    for w in words.tolist():
        if m := spots.get(w):
            x = row & m
            row = ((row + x) | (row - x)) & full
    return len(item) - row.bit_count()


def decided(item: np.ndarray, answer: np.ndarray, words: np.ndarray, copied: float, paraphrased: float, stretch: int | None = None) -> float:
    """The item's share found in order, or 0 where it is neither a copy nor a paraphrase with its answer. A paraphrase has to fit into
    `stretch` words that begin with one of the item's; then the largest share of such a stretch counts."""
    share = subsequence(item, words) / len(item)
    if share >= copied:
        return share
    if share < paraphrased or not len(answer) or subsequence(answer, words) < 0.8 * len(answer):
        return 0.0
    if stretch is None or len(words) <= stretch:
        return share
    best = 0.0
    for start in np.flatnonzero(np.isin(words, item)).tolist():
        part = words[start : start + stretch]
        if (share := subsequence(item, part) / len(item)) > best and share >= paraphrased and subsequence(answer, part) >= 0.8 * len(answer):
            best = share
    return best


def least_share(n: int, share: float) -> int:
    """The least whole number that is at least `share` of n."""
    return next(x for x in range(max(0, int(share * n) - 1), n + 2) if x >= share * n or n and x / n >= share)


@dataclass
class Lookup:
    """The items by the words of which one has to be there. Sizes depend on the group alone."""

    first: np.ndarray  # of each term and one more: where its items begin in `number`
    number: np.ndarray
    counts: np.ndarray  # items x terms: how often the item has the term, at most 255
    need: np.ndarray  # words of each item that have to be found, at most 255
    reach: np.ndarray  # words looked at on either side

    @staticmethod
    def of(space: Space, copied: float, paraphrased: float) -> Lookup:
        pairs = set()
        counts = np.zeros((len(space.items), len(space.terms)), np.uint8)
        need = np.zeros(len(space.items), np.int64)
        for j, (item, answer) in enumerate(zip(space.items, space.answers, strict=True)):
            if not len(item):
                continue
            counts[j] = np.minimum(np.bincount(np.searchsorted(space.terms, item), minlength=len(space.terms)), 255)
            whole = least_share(len(item), copied)
            need[j] = min(whole, least_share(len(item), paraphrased)) if len(answer) else whole
            for words, least in ((item, whole), (answer, least_share(len(answer), 0.8))):
                terms = np.searchsorted(space.terms, words)
                rarest = terms[np.argsort(-space.weights[terms], kind="stable")]
                pairs |= {(int(t), j) for t in rarest[: len(words) - least + 1]}
        order = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        first = np.searchsorted(order[:, 0], np.arange(len(space.terms) + 1))
        reach = np.array([len(x) + STRIDE for x in space.items], np.int64)
        return Lookup(first, order[:, 1], counts, np.minimum(need, 255), reach)

    def places(self, term: np.ndarray, at: np.ndarray, words: int = 1 << 16, cells: int = 1 << 20) -> Iterator[tuple[int, int, int]]:
        """item, start and end of the words around each place that could be accepted. term: of each word, or -1; documents begin at `at`."""
        for offset in range(0, len(term), words):  # a stretch of words at a time, so that what is held is bounded
            here = offset + np.flatnonzero(term[offset : offset + words] >= 0)
            sizes = self.first[term[here] + 1] - self.first[term[here]]
            spot = np.repeat(here, sizes)
            j = self.number[np.repeat(self.first[term[here]], sizes) + np.arange(len(spot)) - np.repeat(np.cumsum(sizes) - sizes, sizes)]
            order = np.argsort(self.reach[j], kind="stable")
            spot, j = spot[order], j[order]
            doc = np.searchsorted(at, spot, "right") - 1
            a, b = np.maximum(spot - self.reach[j], at[doc]), np.minimum(spot + self.reach[j] + 1, at[doc + 1])
            ok = self.enough(term, j, a, b, cells)
            yield from zip(j[ok].tolist(), a[ok].tolist(), b[ok].tolist(), strict=True)

    def enough(self, term: np.ndarray, j: np.ndarray, a: np.ndarray, b: np.ndarray, cells: int = 1 << 20) -> np.ndarray:
        """Which of the stretches a..b hold as many of the words of their item j, each at most as often as the item has it, as have to
        be found. Stretches of like length should stand together."""
        out, i = [np.zeros(0, np.int64)], 0
        while i < len(j):
            width = int((b - a)[i : i + 4096].max())
            part = slice(i, i + max(1, min(4096, cells // max(1, width))))
            grid = a[part, None] + np.arange(width)
            t = np.where(grid < b[part, None], term[np.minimum(grid, len(term) - 1)], -1)
            mine = np.where(t >= 0, self.counts[j[part, None], t], 0)
            ok = np.flatnonzero((mine > 0).sum(1) >= self.need[j[part]])
            t = np.sort(t[ok], axis=1)
            fresh = np.c_[np.ones(len(ok), bool), t[:, 1:] != t[:, :-1]] & (t >= 0)
            out.append(i + ok[np.where(fresh, self.counts[j[part][ok, None], t], 0).sum(1, dtype=np.int64) >= self.need[j[part][ok]]])
            i += len(grid)
        return np.concatenate(out)


def read_items(rows: list) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Word hashes of each item and of its answer: its last sentence, or the last quarter where it has one sentence."""
    items = word_hashes(pa.array([r[1] for r in rows], pa.string()))
    tails = []
    for (_, text), item in zip(rows, items, strict=True):
        body = (text or "").rstrip().rstrip(".!?")
        cut = max(body.rfind(chr(c)) for c in SENTENCE)
        tail = word_hashes(pa.array([body[cut + 1 :]]))[0] if cut >= 0 else item[:0]
        tails.append(tail if 3 <= len(tail) < len(item) else item[-max(3, len(item) // 4) :])
    return items, tails


def empty_space(rows: list, idf: np.ndarray, cosine: float) -> Space | None:
    """The space of a group of items without its basis; None where they have no words."""
    items, answers = read_items(rows)
    terms = np.unique(np.concatenate(items)) if items else np.zeros(0, np.uint32)
    none = np.zeros((0, 0))
    return Space(terms, idf[terms & np.uint32(BUCKETS - 1)], idf, items, answers, [r[0] for r in rows], none, none, np.zeros(0, np.int64), cosine) if len(terms) else None


def passage_products(words: DataFrame, spaces: list[Space], bases: list[np.ndarray]) -> list[np.ndarray]:
    """A'(A Q) for each space's matrix A of corpus passages and its basis Q."""
    shared = words.sparkSession.sparkContext.broadcast((spaces, bases))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros(q.shape, np.float64) for q in shared.value[1]]
        for batch in batches:
            hashes, at = batch_words(batch.column(0))
            for here, q, total in zip(*shared.value, totals, strict=True):
                start, end, _, term = here.windows(hashes, at, PASSAGE)
                for i in range(0, len(start), 4096):
                    a, b = start[i : i + 4096], end[i : i + 4096]
                    y = here.rows(term, a, b, q)
                    for offset in range(PASSAGE):  # A'Y: each word adds its window's row to its term's
                        spot = a + offset
                        fits = np.flatnonzero(spot < b)
                        fits = fits[term[spot[fits]] >= 0]
                        t = term[spot[fits]]
                        order = np.argsort(t, kind="stable")
                        heads = np.flatnonzero(np.r_[True, np.diff(t[order]) > 0]) if len(t) else t
                        if len(t):
                            total[t[order][heads]] += np.add.reduceat(y[fits[order]], heads, axis=0) * here.weights[t[order][heads], None]
        for n, total in enumerate(totals):
            part = np.flatnonzero(np.any(total, 1)).astype(np.int32)
            if len(part):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), n, np.int32)), pa.array(part), pa.array([x.tobytes() for x in total[part].astype(np.float32)], pa.binary())], ["space", "term", "row"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for *t, row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                x = np.frombuffer(row, np.float32).astype(np.float64)
                sums[*t] = sums[*t] + x if (*t,) in sums else x
        if sums:
            n, t = zip(*sums, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(n, pa.int32()), pa.array(t, pa.int32()), pa.array([x.astype(np.float32).tobytes() for x in sums.values()], pa.binary())], ["space", "term", "row"])

    n, kind = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), "space int, term int, row binary"
    out = [np.zeros(q.shape) for q in bases]
    for r in words.select("words").mapInArrow(run, kind).repartition(n, "space", "term").mapInArrow(add, kind).collect():  # one row a term of the groups
        out[r.space][r.term] = np.frombuffer(r.row, np.float32)
    shared.unpersist()
    return out


def with_bases(words: DataFrame, spaces: list[Space], rank: int, seed: int = 9) -> list[Space]:
    """The spaces with the leading right singular vectors of corpus passages and items, and the items' pieces in them."""
    rng = np.random.default_rng(seed)
    own, bases = [], []
    for space in spaces:
        pieces = [(j, x[i : i + PASSAGE]) for j, x in enumerate(space.items) for i in range(0, len(x), PASSAGE)]
        matrix = np.zeros((len(pieces), len(space.terms)), np.float32)
        for i, (_, piece) in enumerate(pieces):
            np.add.at(matrix[i], np.searchsorted(space.terms, piece), 1)
        own.append(matrix * space.weights.astype(np.float32))
        space.piece_of = np.array([j for j, _ in pieces])
        bases.append(np.linalg.qr(rng.standard_normal((len(space.terms), min(rank, len(space.terms)))))[0].astype(np.float32))
    for _ in range(STEPS):
        products = passage_products(words, spaces, bases)
        bases = [np.linalg.qr(x + a.T @ (a @ q))[0].astype(np.float32) for x, a, q in zip(products, own, bases, strict=True)]
    for space, a, q in zip(spaces, own, bases, strict=True):
        latent = a @ q
        space.basis, space.latent = q, (latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)).astype(np.float32)
    return spaces


def latent_candidates(space: Space, lookup: Lookup, term: np.ndarray, at: np.ndarray, start: np.ndarray, end: np.ndarray, similar: float) -> Iterator[tuple[int, int, int]]:
    """item, start and end of the words around the window's middle, two and a half times as many as the item has, for each pair with enough
    cosine in the latent space, if they hold enough of the item's words to be accepted."""
    reach = np.array([5 * len(x) // 4 for x in space.items])
    for i in range(0, len(start), 4096):
        a, b = start[i : i + 4096], end[i : i + 4096]
        y = space.rows(term, a, b, space.basis)
        y /= np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-9)
        w, piece = np.nonzero(y @ space.latent.T >= similar)
        j = space.piece_of[piece]
        order = np.argsort(reach[j], kind="stable")
        w, j = w[order], j[order]
        doc, middle = np.searchsorted(at, a[w], "right") - 1, (a[w] + b[w]) // 2
        low, high = np.maximum(at[doc], middle - reach[j]), np.minimum(at[doc + 1], middle + reach[j])
        ok = lookup.enough(term, j, low, high)
        yield from zip(j[ok].tolist(), low[ok].tolist(), high[ok].tolist(), strict=True)


def search(words: DataFrame, spaces: list[Space], key: str, similar: float, copied: float, paraphrased: float) -> DataFrame:
    """key, items array<bigint>, share double (the largest) and ROW for each document, repeated rows one by one."""
    shared = words.sparkSession.sparkContext.broadcast([(x, Lookup.of(x, copied, paraphrased)) for x in spaces])

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            hashes, at = batch_words(batch.column(1))
            lists, best = [[] for _ in range(batch.num_rows)], [0.0] * batch.num_rows
            for here, lookup in shared.value:
                start, end, _, term = here.windows(hashes, at, STRIDE)
                found: dict[tuple[int, int], float] = {}

                near = ((*x, paraphrased, STRIDE) for x in lookup.places(term, at))
                far = ((*x, min(copied, paraphrased + APART), None) for x in latent_candidates(here, lookup, term, at, start, end, similar))
                for j, a, b, least, more in chain(near, far):
                    doc = int(np.searchsorted(at, a, "right")) - 1
                    if found.get((doc, j), 0) < 1:
                        share = decided(here.items[j], here.answers[j], hashes[a:b], copied, least, more and len(here.items[j]) + more)
                        if share > found.get((doc, j), 0):
                            found[doc, j] = share
                for (doc, j), share in found.items():
                    lists[doc].append(here.ids[j])
                    best[doc] = max(best[doc], share)
            lists = [sorted(set(x), key=lambda i: (i is None, i or 0)) for x in lists]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(lists, pa.list_(pa.int64())), pa.array(best, pa.float64()), batch.column(2)], [key, "items", "share", ROW])

        return work

    return map_batches(words.select(key, "words", ROW), make, f"`{key}` {words.schema[key].dataType.simpleString()}, items array<bigint>, share double, {ROW} bigint")


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", cosine: float = 0.45, similar: float = 0.5, copied: float = 0.8, paraphrased: float = 0.5, rank: int = 128, group: int = 256, groups: int = 16) -> DataFrame:
    """key, contaminated boolean, items array<bigint> (ids of the items found, ascending), share double for each row of docs. A window is
    projected if its weight on the items' terms is at least cosine**2 of its whole weight."""
    words = stored_words(docs, key, text)
    counts, total = document_frequencies(words)
    idf = np.log((1 + total) / (1 + counts)).astype(np.float64)
    # Stored, so that the rows' numbers stay what they are.
    named = stored(benchmark.select(F.monotonically_increasing_id().alias("n"), F.col(item).cast("bigint").alias("i"), F.col(item_text).alias("t")), "benchmark")
    found, passes, last = None, 0, -1
    while True:  # pass after pass, in the order of rows
        rows = named.filter(F.col("n") > last).orderBy("n").limit(group * groups).collect()
        if not rows:
            break
        last = rows[-1].n
        spaces = [empty_space([(r.i, r.t) for r in rows[i : i + group]], idf, cosine) for i in range(0, len(rows), group)]
        if spaces := [x for x in spaces if x is not None]:
            part = search(words, with_bases(words, spaces, rank), key, similar, copied, paraphrased)
            found, passes = part if found is None else found.unionByName(part), passes + 1
    if found is None:
        return words.select(key, F.lit(False).alias("contaminated"), F.array().cast("array<bigint>").alias("items"), F.lit(0.0).alias("share"))
    if passes > 1:
        found = found.groupBy(ROW, key).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.max("share").alias("share"))
    return found.select(key, (F.size("items") > 0).alias("contaminated"), "items", "share")
