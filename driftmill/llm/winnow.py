"""Passages of held-out test items inside a corpus, by winnowing.

Texts are reduced to words without case, marks, accents or look-alike letters. Every K words give a hash, and of every W
hashes in a row the smallest is kept; two texts that share K + W - 1 words in a row then share a kept hash for sure. With
K + W - 1 = 5 that holds for every stretch of 14 words with one word in eight changed or missing. Kept hashes of corpus
and test items are joined, and each hit is extended in both directions over changed, missing and added words. A hit that
this finds no stretch for is extended once more over every combination of changed and missing words, which decides exactly.

The test side is broadcast only while it has at most INDEX_LIMIT kept hashes, so that a hit is extended where the text is
read and the corpus isn't shuffled at all. Beyond it, kept hashes of both sides meet in a shuffle join on the hash, with
hot hashes salted, which says only which hashes, texts and items met at all; no pairs are made. The texts that met are then
read again, once for every block of the items that met, of at most INDEX_LIMIT words, each block broadcast in turn.

Every item whose stretch is long enough is found, also where another item agrees with the same words better; leaks with
best keeps only the items that a stretch is credited to.

Defined results: a null or empty text holds nothing; an item of fewer than MIN_WORDS words can't be found; equal texts
are found each for itself; an empty table on either side gives no rows.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from driftmill.session import broadcast_if_small, cut, join_hot, spread

#: Words of a hash, hashes of a window, words that a shared stretch must have, and words for each that may be changed or missing.
K, W, MIN_WORDS, PER_ERROR = 4, 2, 14, 8
#: Errors beyond which a stretch needn't be looked for: one with more holds a shorter one that is long enough, with at most 3.
MAX_ERRORS = 3
#: Kept hashes of the test side up to which it is broadcast.
INDEX_LIMIT = 2_000_000
#: Parts that the occurrences of one hash in the corpus are salted into.
SALTS = 16

#: Letters that look alike, Cyrillic to Latin (fixed values).
LOOK_ALIKE = dict(zip("авеёзікмнорстухѕјһԁԛԝɡ", "abee3ikmhopctyxsjhdqwg", strict=True))
_MARKS = re.compile(r"\[\d{1,4}\]|<[/a-zA-Z!][^<>]{0,80}>|\((?:c|с|r|tm|\d{1,3})\)|[№#]", re.IGNORECASE)
_WORD = re.compile(r"\w+")


class _Fold(dict):
    """Translation of code points, filled as they are met: look-alikes to one letter, accents and format characters to nothing."""

    def __missing__(self, code: int) -> str | int:
        out = []
        for c in unicodedata.normalize("NFKD", chr(code)).lower():
            kind = unicodedata.category(c)
            if kind in ("Mn", "Me", "Cf"):
                continue
            out.append(LOOK_ALIKE.get(c, c))
        self[code] = value = "".join(out).replace("_", " ")
        return value


_FOLD = _Fold()


def words(text: str) -> list[str]:
    """Words of a text in the form in which they are compared."""
    return _WORD.findall(_MARKS.sub(" ", text).translate(_FOLD))


def word_hash(word: str, known: dict[str, int]) -> int:
    if (h := known.get(word)) is None:
        if len(known) > 1_000_000:
            known.clear()
        h = known[word] = xxhash.xxh64_intdigest(word)
    return h


def kept(hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Winnowed fingerprints of texts laid end to end: their values, and the place of their first word.

    hashes: a hash for each word; sizes: words of each text. A text of fewer than K words has none.
    """
    n = len(hashes)
    if n < K:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    with np.errstate(over="ignore"):
        gram = np.zeros(n - K + 1, np.uint64)
        for j in range(K):
            gram = gram * np.uint64(0x9E3779B97F4A7C15) + hashes[j : n - K + 1 + j]
        gram ^= gram >> np.uint64(29)
        gram *= np.uint64(0xBF58476D1CE4E5B9)
        gram ^= gram >> np.uint64(32)
    text = np.repeat(np.arange(len(sizes)), sizes)
    whole = text[: n - K + 1] == text[K - 1 :]
    top = np.uint64(2**64 - 1)
    gram = np.where(whole, gram, top)
    least = gram.copy()  # of the window that starts here
    for j in range(1, W):
        least[:-j] = np.minimum(least[:-j], gram[j:])
    chosen = np.zeros(len(gram), bool)
    for j in range(W):  # the windows that hold this place
        chosen[j:] |= gram[j:] == least[: len(gram) - j]
    at = np.flatnonzero(chosen & whole)
    return gram[at], at


def _align(doc: list[str], item: list[str], i: int, j: int, step: int) -> tuple[int, int, list[int]]:
    """Extends a match beyond (i, j) one way; where it ends (outside) in document and item, and the item's places that differ."""
    errors: list[int] = []
    n, m = len(doc), len(item)
    inside = lambda a, b: 0 <= a < n and 0 <= b < m
    good = (i, j, 0)  # behind the last matched word, and errors up to there
    while inside(i, j):
        if doc[i] == item[j]:
            i, j = i + step, j + step
            good = (i, j, len(errors))
            continue
        if len(errors) - good[2] >= 2:
            break
        for di, dj in ((1, 1), (0, 1), (1, 0), (2, 2), (0, 2), (2, 0)):  # changed, missing, added
            a, b = i + di * step, j + dj * step
            if inside(a, b) and doc[a] == item[b] and (not inside(a + step, b + step) or doc[a + step] == item[b + step]):
                errors += [j + e * step for e in range(dj)] or [j]  # an added word counts at the place where it stands
                i, j = a, b
                break
        else:
            break
    return good[0], good[1], errors[: good[2]]


def _reach(doc: list[str], item: list[str], i: int, j: int, step: int) -> list[tuple[int, int]]:
    """How far a match goes beyond (i, j) one way with at most 0, 1, ... MAX_ERRORS changed or missing words: words of the item and of the document up to the last equal one."""
    n, m = (len(doc) - i, len(item) - j) if step > 0 else (i + 1, j + 1)
    far = {0: 0}  # farthest word of the item, by the number of missing words
    best, out = (0, 0), []
    for errors in range(MAX_ERRORS + 1):
        if errors:
            far = {gone: 1 + max(far.get(gone, 0), far.get(gone - 1, 0)) for gone in range(errors + 1)}
        for gone, x in far.items():
            y = x
            while y < m and y - gone < n and doc[i + (y - gone) * step] == item[j + y * step]:
                y += 1
            if y > x and y > best[0]:
                best = (y, y - gone)
            far[gone] = y
        out.append(best)
    return out


def _exact(doc: list[str], item: list[str], i: int, j: int) -> tuple[int, int, int] | None:
    """(words that agree, begin, end in the document) of the best stretch through (i, j) with at most MAX_ERRORS changed or missing words."""
    right, left = _reach(doc, item, i, j, 1), _reach(doc, item, i - 1, j - 1, -1)
    if left[-1][0] + right[-1][0] < MIN_WORDS:
        return None
    told = []
    for a, (before, back) in enumerate(left):
        for b, (behind, on) in enumerate(right[: MAX_ERRORS + 1 - a]):
            size = before + behind
            if size >= MIN_WORDS and a + b <= size // PER_ERROR:
                told.append((size - a - b, i - back, i + on))
    return max(told, default=None)


def stretches(doc: list[str], item: list[str], hits: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(words that agree, begin, end in the document) of each long enough stretch of the item; hits are places (in doc, in item) of equal K-grams, in the order of the document."""
    done: set[tuple[int, int]] = set()
    out = []
    for i, j in hits:
        if (i - j, j // PER_ERROR) in done:
            continue
        to, end, right = _align(doc, item, i, j, 1)
        since, begin, left = _align(doc, item, i - 1, j - 1, -1)
        done |= {(i - j, x // PER_ERROR) for x in range(j, end)}
        errors = sorted(set(left + right))
        starts, ends = [begin + 1, *(e + 1 for e in errors)], [*errors, end]
        best = 0  # over every stretch from just behind one error to just before another
        for a, s in enumerate(starts):
            for b in range(a, len(ends)):
                size = ends[b] - s
                if size >= MIN_WORDS and b - a <= size // PER_ERROR:
                    best = max(best, size - (b - a))
        if best:
            out.append((best, since + 1, to))
    seen: set[tuple[int, int]] = set()  # runs of equal words, by their shift and end
    spans, k, until = sorted((lo, hi) for _, lo, hi in out), 0, 0
    for i, j in hits:
        while k < len(spans) and spans[k][0] <= i:
            until, k = max(until, spans[k][1]), k + 1
        if i < until:  # inside a stretch already found
            continue
        end = j + K
        while end < len(item) and end + i - j < len(doc) and item[end] == doc[end + i - j]:
            end += 1
        if (i - j, end) not in seen:
            seen.add((i - j, end))
            if told := _exact(doc, item, i, j):
                out.append(told)
                until = told[2]
    return out


def credited(found: list[tuple[int, int, int, int]]) -> set[int]:
    """Items of one document, from (item, words that agree, begin, end) of its stretches.

    Test items share wording with each other. A stretch is credited to the item it agrees with in the most words: it
    doesn't count for an item if half of it or more lies in a stretch that agrees with another item in more words.
    """
    return {
        i for i, n, lo, hi in found
        if not any(i2 != i and n2 > n and 2 * (min(hi, hi2) - max(lo, lo2)) >= hi - lo for i2, n2, lo2, hi2 in found)
    }


class Index:
    """Fingerprints of the test items, sorted, with item and place."""

    def __init__(self, items: list[tuple[int, str]]):
        known: dict[str, int] = {}
        self.ids = [i for i, _ in items]
        self.words = [words(t) for _, t in items]
        sizes = np.array([len(w) for w in self.words], np.int64)
        hashes = np.array([word_hash(w, known) for ws in self.words for w in ws], np.uint64)
        values, at = kept(hashes, sizes)
        item = np.repeat(np.arange(len(sizes)), sizes)[at] if len(at) else at
        place = at - (np.cumsum(sizes) - sizes)[item] if len(at) else at
        order = np.argsort(values, kind="stable")
        self.values, self.item, self.place = values[order], item[order], place[order]

    def held(self, texts: list[str | None], known: dict[str, int]) -> list[tuple[int, list[tuple[int, int, int, int]]]]:
        """(number of the text, stretches) of every text that holds a passage; a stretch is (number of the item, words that agree, begin, end)."""
        split = [words(t) if t else [] for t in texts]
        sizes = np.array([len(w) for w in split], np.int64)
        hashes = np.array([word_hash(w, known) for ws in split for w in ws], np.uint64)
        values, at = kept(hashes, sizes)
        lo, hi = np.searchsorted(self.values, values, "left"), np.searchsorted(self.values, values, "right")
        hit = np.flatnonzero(hi > lo)
        if not len(hit):
            return []
        first = np.cumsum(sizes) - sizes
        text = np.searchsorted(first, at[hit], "right") - 1
        # texts without words share their start with the next text; the last of equal starts is the one with words
        found: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for h, t in zip(hit.tolist(), text.tolist(), strict=True):
            for x in range(lo[h], hi[h]):
                found.setdefault((t, int(self.item[x])), []).append((int(at[h] - first[t]), int(self.place[x])))
        by_text: dict[int, list[tuple[int, int, int, int]]] = {}
        for (t, i), hits in found.items():
            if told := stretches(split[t], self.words[i], hits):
                by_text.setdefault(t, []).extend((i, *s) for s in told)
        return list(by_text.items())

    def search(self, texts: list[str | None], known: dict[str, int], best: bool = True) -> list[tuple[int, int]]:
        """(number of the text, item id) of every text that holds a passage of an item. best: only items that a stretch is credited to."""
        return [(t, self.ids[i]) for t, told in self.held(texts, known) for i in sorted(credited(told) if best else {i for i, *_ in told})]


def leaks(documents: DataFrame, benchmark: DataFrame, doc: str = "doc_id", item: str = "item_id", text: str = "text", limit: int = INDEX_LIMIT, best: bool = False, block: int = INDEX_LIMIT) -> DataFrame:
    """Documents that hold a passage of a test item: columns doc, item. best: a stretch counts only for the item it agrees with in the most words. limit: words of the test side up to which it is broadcast whole; block: words of a block beyond that."""
    items = benchmark.where(F.length(text) > 0).select(item, text)
    size = items.agg(F.coalesce(F.sum(F.size(F.split(text, r"\s+"))), F.lit(0)).alias("n")).first()["n"]
    if size <= limit:
        return _leaks_near(spread(documents.select(doc, text)), items, doc, item, text, best)
    return _leaks_far(documents.select(doc, text), items, doc, item, text, best, block)


def _types(df: DataFrame, *columns: str) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns)


def _leaks_near(documents: DataFrame, items: DataFrame, doc: str, item: str, text: str, best: bool) -> DataFrame:
    shared = documents.sparkSession.sparkContext.broadcast([(r[0], r[1]) for r in items.collect()])  # within INDEX_LIMIT words
    kind = to_arrow_type(items.schema[item].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, known = Index(shared.value), {}
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                found = index.search(part.column(1).to_pylist(), known, best)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array([t for t, _ in found], pa.int64())), pa.array([i for _, i in found], kind)], names=[doc, item])

    return documents.where(F.length(text) > 0).mapInArrow(run, f"{_types(documents, doc)}, {_types(items, item)}").distinct()


def _prints(df: DataFrame, key: str, text: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in batches:
            split = [words(t) for t in batch.column(1).to_pylist()]
            sizes = np.array([len(w) for w in split], np.int64)
            values, at = kept(np.array([word_hash(w, known) for ws in split for w in ws], np.uint64), sizes)
            first = np.cumsum(sizes) - sizes
            row = np.repeat(np.arange(len(sizes)), sizes)[at] if len(at) else at
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int64())), pa.array(values.view(np.int64)), pa.array((at - first[row]).astype(np.int32) if len(at) else at, pa.int32())], names=[key, "print", "place"])

    return df.where(F.length(text) > 0).select(key, text).mapInArrow(run, f"{_types(df, key)}, print bigint, place int")


def _leaks_far(documents: DataFrame, items: DataFrame, doc: str, item: str, text: str, best: bool, block: int) -> DataFrame:
    documents = documents.where(F.length(text) > 0).withColumn("__text", F.xxhash64(text))  # texts that share a hash are only read for nothing
    theirs = cut(_prints(items, item, text).select(item, "print").distinct())
    wanted = theirs.select("print").distinct().withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    ours = _prints(documents, "__text", text).select("__text", "print").withColumn("salt", F.pmod("__text", F.lit(SALTS)).cast("int"))
    met = cut(ours.join(wanted, ["print", "salt"], "left_semi").distinct())
    texts = join_hot(documents, met.select("__text").distinct(), "__text", "left_semi")
    known = items.join(broadcast_if_small(theirs.join(broadcast_if_small(met.select("print").distinct()), "print", "left_semi").select(item).distinct()), item, "left_semi").withColumn("__words", F.size(F.split(text, r"\s+")))
    texts, known = cut(texts), cut(known)
    blocks = max(1, -(-(known.agg(F.sum("__words")).first()[0] or 0) // block))
    number = F.pmod(F.xxhash64(item, text), F.lit(blocks))
    kind = to_arrow_type(items.schema[item].dataType)
    held = None
    for b in range(blocks):
        shared = documents.sparkSession.sparkContext.broadcast([(r[0], r[1]) for r in known.where(number == b).select(item, text).collect()])  # about block words

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index, hashes = Index(shared.value), {}
            for batch in batches:
                for lo in range(0, batch.num_rows, 512):
                    part = batch.slice(lo, 512)
                    rows = [(t, index.ids[i], n, a, z) for t, told in index.held(part.column(2).to_pylist(), hashes) for i, n, a, z in told]
                    take = pa.array([r[0] for r in rows], pa.int64())
                    yield pa.RecordBatch.from_arrays([part.column(0).take(take), part.column(1).take(take), pa.array([r[1] for r in rows], kind), *(pa.array([r[k] for r in rows], pa.int32()) for k in (2, 3, 4))], names=[doc, "__text", item, "n", "lo", "hi"])

        one = texts.select(doc, "__text", text).mapInArrow(run, _types(texts, doc, "__text") + f", {_types(items, item)}, n int, lo int, hi int")
        held = one if held is None else held.unionByName(one)
    if not best:
        return held.select(doc, item).distinct()
    lists = held.distinct().groupBy(doc, "__text").agg(F.collect_list(F.struct(F.col(item).alias("i"), "n", "lo", "hi")).alias("s"))  # the stretches of one text
    inside = lambda x, y: 2 * (F.least(x.hi, y.hi) - F.greatest(x.lo, y.lo)) >= x.hi - x.lo
    first = F.filter("s", lambda x: ~F.exists("s", lambda y: (y.i != x.i) & (y.n > x.n) & inside(x, y)))
    return lists.select(doc, F.explode(first).alias("x")).select(doc, F.col("x.i").alias(item)).distinct()
