"""Benchmark decontamination by suffix arrays over the training texts.

Every task cuts its documents into shards and builds the word suffix array of
each. All benchmark suffixes are binary-searched in it together: first by the
packed leading words, then word by word inside the intervals found. A suffix
whose interval is not empty at the length of a window marks the words of all
its occurrences; the interval at its greatest length gives the longest match.
Of suffixes and shard, the smaller side is looked up in the other by the packed
leading words, so that a shard costs in proportion to its own words however
long the benchmark is. From an occurrence of a window on, the length of the
match is found by halving over running hashes of item and shard.

Words are compared by 64-bit hashes. Training suffixes that begin with a word
of no item sort outside every interval and are left out of the array. The
benchmark is read in blocks of at most some ``BLOCK_WORDS`` words; several blocks
are searched one after another, each against all documents. Longer items are cut
into pieces that share all but one word of a window, which loses no window; the
longest match of a document ends with its piece there. ``longest_matches`` keeps
items whole.

Null texts have no words and are never contaminated. Rows are judged one by
one, so repeated rows and ids get equal results. An item without id counts as
one item with an empty id, repeated item ids as one item. An empty benchmark
marks nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardfeat.llm.flat import LETTERED, Flat, flat, mix, plain, slices, words
from cardfeat.llm.tables import small_batches
from cardfeat.session import stage

WINDOW = 13
#: A document is contaminated if at least one in so many of its words is hit.
HIT_SHARE = 20
#: Words of the benchmark that one pass holds, in every task.
BLOCK_WORDS = 4_000_000
_BASE = 0x9E3779B97F4A7C15
#: A word as in LETTERED, before letters are lowered.
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


@dataclass
class Items:
    """Benchmark words as codes (one 0 between items) and the different windows to search."""

    vocabulary: np.ndarray  #: sorted hashes; the code of a word is its place plus one
    codes: np.ndarray
    starts: np.ndarray  #: first word of each suffix that is searched
    sizes: np.ndarray  #: words in its window
    rests: np.ndarray  #: words to the end of the item
    owners: list[list[str]]  #: items that have the window
    places: list[list[tuple[str, int]]]  #: item and word position of each suffix with that window
    bits: int
    depth: int
    #: by number of packed words: the suffixes in the order of these words, and the words
    heads: list[tuple[int, np.ndarray, np.ndarray]]
    order: np.ndarray  #: rank of the first place of each suffix


def _running(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums of hashed codes and the factors that make sums from any position on comparable."""
    power, inverse = (np.full(len(codes) + 1, base, dtype=np.uint64) for base in (_BASE, pow(_BASE, -1, 1 << 64)))
    power[0] = inverse[0] = 1
    power, inverse = np.multiply.accumulate(power), np.multiply.accumulate(inverse)
    return np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(codes.astype(np.uint64)) * power[:-1]))), inverse


def read_items(ids: list[str], texts: list[str], window: int = WINDOW, skipped: list[int] | None = None) -> Items:
    """Prepare items, or pieces of them after ``skipped`` words each, for the search."""
    part = flat(pa.array(texts, pa.string()))
    w = words(part, LETTERED, lower=True)
    vocabulary = np.unique(w.hashes)
    plain_codes = np.searchsorted(vocabulary, w.hashes) + 1
    text = w.text
    codes = np.zeros(len(text) + len(texts) + 1, dtype=np.int64)
    moved = np.arange(len(text)) + text
    codes[moved] = plain_codes
    counts = w.counts
    size = np.minimum(counts, window)
    wanted = w.first[text] + counts[text] - np.arange(len(text)) >= size[text]
    at = np.flatnonzero(wanted)
    sizes, rests = size[text[at]], (w.first[text] + counts[text] - np.arange(len(text)))[at]
    sums, inverse = _running(w.hashes)
    rest_hashes = (sums[at + rests] - sums[at]) * inverse[at]
    groups: dict[tuple, int] = {}
    starts, owners, places, keep = [], [], [], []
    for k, i in enumerate(at):
        # suffixes with the same words to the end of their item need one search; they are told apart by hashes
        key = (int(sizes[k]), int(rests[k]), int(rest_hashes[k]))
        g = groups.setdefault(key, len(starts))
        if g == len(starts):
            starts.append(moved[i])
            keep.append(k)
            owners.append([])
            places.append([])
        owners[g].append(ids[text[i]])
        places[g].append((ids[text[i]], int(i - w.first[text[i]]) + (skipped[text[i]] if skipped else 0)))
    starts, sizes = np.array(starts, dtype=np.int64), sizes[keep].astype(np.int64)
    bits = max(1, int(len(vocabulary)).bit_length())
    packed_words = np.minimum(sizes, max(1, 64 // bits))
    heads = []
    for d in np.unique(packed_words).tolist():
        some = np.flatnonzero(packed_words == d)
        head = _pack(codes, starts[some], bits, d)
        by = np.argsort(head, kind="stable")
        heads.append((d, some[by], head[by]))
    firsts = [min(p) for p in places]
    rank = {place: k for k, place in enumerate(sorted(set(firsts)))}
    return Items(
        vocabulary,
        codes,
        starts,
        sizes,
        rests[keep].astype(np.int64),
        [sorted(set(o)) for o in owners],
        places,
        bits,
        int(counts.max(initial=0)),
        heads,
        np.array([rank[f] for f in firsts], dtype=np.int64),
    )


def _pack(codes: np.ndarray, at: np.ndarray, bits: int, count: int) -> np.ndarray:
    """The codes of ``count`` words from each position on, in one number."""
    packed = np.zeros(len(at), dtype=np.uint64)
    for k in range(count):
        packed = (packed << np.uint64(bits)) | codes[at + k].astype(np.uint64)
    return packed


def suffix_array(codes: np.ndarray, bits: int, depth: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Positions of known words in the order of the words that follow, for ``depth`` words or more.

    Also the packed first words of each position in that order, and their number.
    ``codes`` ends in ``depth`` + 64 zeros at least.
    """
    count = max(1, 64 // bits)
    at = np.flatnonzero(codes)
    packed = _pack(codes, at, bits, count)
    order = np.argsort(packed)
    packed = packed[order]
    array = at[order]
    rank = np.zeros(len(codes), dtype=np.int64)
    n, have = len(array), count
    if n:
        fresh = np.concatenate(([True], packed[1:] != packed[:-1]))
        group = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
        rank[array] = group + 1
        slots = np.arange(n)
        while have < depth:
            # only groups of several suffixes are sorted further
            same = group[slots[1:]] == group[slots[:-1]] if len(slots) > 1 else np.zeros(0, bool)
            tied = np.concatenate((same, [False])) | np.concatenate(([False], same))
            slots = slots[tied]
            if not len(slots):
                break
            key = group[slots] * (n + 1) + rank[array[slots] + have]
            by = np.argsort(key, kind="stable")
            array[slots] = array[slots[by]]
            key = key[by]
            new = np.concatenate(([True], key[1:] != key[:-1]))
            group[slots] = np.maximum.accumulate(np.where(new, slots, 0))
            rank[array[slots]] = group[slots] + 1
            have *= 2
    return array, packed, count


def _narrow(codes, array, lo, hi, target, depth):
    """Binary search inside each interval for the suffixes that have the target word at their depth."""
    bounds = []
    for above in (False, True):
        a, b = lo.copy(), hi.copy()
        live = np.flatnonzero(a < b)
        while len(live):
            mid = (a[live] + b[live]) >> 1
            word = codes[array[mid] + depth[live]]
            right = word <= target[live] if above else word < target[live]
            a[live[right]] = mid[right] + 1
            b[live[~right]] = mid[~right]
            live = live[a[live] < b[live]]
        bounds.append(a)
    return bounds


def search(codes: np.ndarray, items: Items, longest: bool = False):
    """Occurrences of the items' windows: query, interval in the array, and the array.

    With ``longest`` the intervals are those of the longest match of each suffix, with its length.
    """
    array, packed, count = suffix_array(codes, items.bits, items.depth if longest else int(items.sizes.max(initial=0)))
    q = np.arange(len(items.starts))
    none = np.zeros(0, np.int64)
    if not len(array) or not len(q):
        return array, none, none, none, none
    depth = np.minimum(items.sizes, count)
    lo, hi = np.zeros(len(q), np.int64), np.zeros(len(q), np.int64)
    for d, some, head in items.heads:
        shift = np.uint64(items.bits * (count - d))
        mine = packed >> shift
        mine = mine[np.concatenate(([True], mine[1:] != mine[:-1]))]
        if len(mine) < len(head):
            first, last = np.searchsorted(head, mine, side="left"), np.searchsorted(head, mine, side="right")
            size = last - first
            met = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size)
        else:
            at = np.minimum(np.searchsorted(mine, head), len(mine) - 1)
            met = np.flatnonzero(mine[at] == head)
        low = head[met] << shift
        lo[some[met]] = np.searchsorted(packed, low, side="left")
        hi[some[met]] = np.searchsorted(packed, low | ((np.uint64(1) << shift) - np.uint64(1)), side="right")
    live = np.flatnonzero(lo < hi)
    q, lo, hi, depth = q[live], lo[live], hi[live], depth[live]
    done: list[tuple] = []
    while len(q):
        limit = items.rests[q] if longest else items.sizes[q]
        end = depth >= limit
        if end.any():
            done.append((q[end], lo[end], hi[end], depth[end]))
            q, lo, hi, depth = q[~end], lo[~end], hi[~end], depth[~end]
            continue
        target = items.codes[items.starts[q] + depth]
        new_lo, new_hi = _narrow(codes, array, lo, hi, target, depth)
        lost = new_lo >= new_hi
        if longest:
            long = lost & (depth >= items.sizes[q])
            done.append((q[long], lo[long], hi[long], depth[long]))
        q, lo, hi, depth = q[~lost], new_lo[~lost], new_hi[~lost], depth[~lost] + 1
    if not done:
        return array, none, none, none, none
    return array, *(np.concatenate([x[k] for x in done]) for k in range(4))


@dataclass
class Shard:
    """Word codes of consecutive documents with a 0 after each."""

    codes: np.ndarray
    first: np.ndarray  #: place of the first word of each document, one entry more than documents
    counts: np.ndarray


def shard(part: Flat, items: Items) -> Shard:
    w = words(part, LETTERED, lower=True)
    place = np.searchsorted(items.vocabulary, w.hashes)
    place[place == len(items.vocabulary)] = 0
    known = items.vocabulary[place] == w.hashes if len(items.vocabulary) else np.zeros(len(place), bool)
    n = len(part)
    codes = np.zeros(len(w.hashes) + n + items.depth + 128, dtype=np.int64)
    codes[np.arange(len(w.hashes)) + w.text] = np.where(known, place + 1, 0)
    return Shard(codes, w.first + np.arange(n + 1), w.counts)


def _extended(items: Items, s: Shard, query: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Words that item and document share from each occurrence of a window on, to the end of the item at most."""
    (sums, inverse), (found, turned) = _running(items.codes), _running(s.codes)
    start = items.starts[query]
    least, most = items.sizes[query], items.rests[query]
    while (least < most).any():
        half = (least + most + 1) >> 1
        same = (sums[start + half] - sums[start]) * inverse[start] == (found[at + half] - found[at]) * turned[at]
        least, most = np.where(same, half, least), np.where(same, most, half - 1)
    return least


@dataclass
class Found:
    """What a document has of the benchmark."""

    ranges: list[tuple[int, int]]
    items: list[str]
    longest: tuple[int, str, int, int] | None = None  #: words, item, word of the item and of the document


def hits(part: Flat, items: Items, longest: bool = False) -> tuple[np.ndarray, dict[int, Found]]:
    """Word counts of each document, and of those with occurrences the hit word ranges, the items and the longest match."""
    s = shard(part, items)
    array, q, lo, hi, _ = search(s.codes, items)
    if not len(q):
        return s.counts, {}
    size = hi - lo
    query = np.repeat(q, size)
    at = array[np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(lo, size)]
    doc = np.searchsorted(s.first, at, side="right") - 1
    steps = np.zeros(len(s.codes) + 1, dtype=np.int64)
    np.add.at(steps, at, 1)
    np.add.at(steps, at + items.sizes[query], -1)
    covered = np.cumsum(steps) > 0
    edges = np.flatnonzero(np.diff(np.concatenate(([False], covered, [False])).astype(np.int8)))
    begins, ends = edges[0::2], edges[1::2]
    of = np.searchsorted(s.first, begins, side="right") - 1
    found: dict[int, Found] = {}
    for d, b, e in zip(of.tolist(), begins.tolist(), ends.tolist()):
        start = int(s.first[d])
        found.setdefault(d, Found([], [])).ranges.append((b - start, e - start))
    both = np.unique(np.stack((doc, query), axis=1), axis=0)
    for d, k in both.tolist():
        found[d].items.extend(items.owners[k])
    if longest:
        length = _extended(items, s, query, at)
        by = np.lexsort((at, items.order[query], -length, doc))
        by = by[np.concatenate(([True], doc[by][1:] != doc[by][:-1]))]
        for d, k, n, place in zip(doc[by].tolist(), query[by].tolist(), length[by].tolist(), at[by].tolist()):
            found[d].longest = (n, *min(items.places[k]), place - int(s.first[d]))
    return s.counts, found


def _pieces(text: str) -> Iterator[tuple[str, int]]:
    """A text in pieces of about ``BLOCK_WORDS`` words, each window in one of them, and the words before each."""
    starts, end, skipped = [], 0, 0  # of the words of a piece
    step = max(BLOCK_WORDS, WINDOW)
    for word in _WORD.finditer(text):
        if len(starts) == step + WINDOW - 1:
            yield text[starts[0] : end], skipped
            starts, skipped = starts[step:], skipped + step
        starts.append(word.start())
        end = word.end()
    if starts:
        yield text[starts[0] : end], skipped


def _blocks(benchmark: DataFrame, key: str, text: str, whole: bool = False) -> Iterator[Items]:
    """The benchmark in blocks of a bounded number of words, or at least one ``whole`` item."""
    ids: list[str] = []
    texts: list[str] = []
    skipped: list[int] = []
    size = 0
    rows = benchmark.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    for row in rows.toLocalIterator():
        # a word and what follows it have two characters at least
        short = whole or len(row["t"]) // 2 + 1 <= BLOCK_WORDS
        for piece, before in ((row["t"], 0),) if short else _pieces(row["t"]):
            ids.append(row["k"])
            texts.append(piece)
            skipped.append(before)
            size += len(piece) // 2 + 1
            if size >= BLOCK_WORDS:
                yield read_items(ids, texts, skipped=skipped)
                ids, texts, skipped, size = [], [], [], 0
    if ids:
        yield read_items(ids, texts, skipped=skipped)


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


_LONGEST = "struct<n_words:int,item_id:string,item_word:int,doc_word:int>"


def annotate(docs: DataFrame, benchmark: DataFrame, prefix: str, text: str = "text", item: str = "item_id", longest: bool = False) -> DataFrame:
    """The documents with columns ``<prefix>words``, ``<prefix>hit``, ``<prefix>items``, ``<prefix>ranges`` and ``<prefix>longest``.

    ``ranges`` lists the begin and end of each run of hit words, one after the other. ``longest`` is null, or if
    it is wanted the longest match with its item and its first words in item and document, both counted from 0;
    of equal lengths that of the first item as text, then the first in the item, then in the document.
    """
    start = {"words": "bigint", "hit": "bigint", "items": "array<string>", "ranges": "array<int>", "longest": _LONGEST}
    names = [prefix + k for k in start]
    blocks = _blocks(benchmark, item, "text")
    current, following = next(blocks, None) or read_items([], []), next(blocks, None)
    frame = small_batches(docs)
    for name, kind in zip(names, start.values()):
        frame = frame.withColumn(name, F.lit(None).cast(kind))
    match = pa.struct([("n_words", pa.int32()), ("item_id", pa.string()), ("item_word", pa.int32()), ("doc_word", pa.int32())])
    kinds = (pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int32()), match)

    def marked(items: Items):
        shared = frame.sparkSession.sparkContext.broadcast(items)

        def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = [batch.schema.get_field_index(n) for n in (*names, text)]
                old = [batch.column(k).to_pylist() for k in at[2:5]]
                counts, hit, owners, ranges, best = [], [], [], [], []
                for first, part in slices(plain(batch.column(at[5]))):
                    n, found = hits(part, shared.value, longest)
                    counts.extend(n.tolist())
                    for d in range(len(part)):
                        new = found.get(d) or Found([], [])
                        before = old[1][first + d] or []
                        spans = _merged(new.ranges + list(zip(before[0::2], before[1::2])))
                        hit.append(sum(b - a for a, b in spans))
                        ranges.append([x for span in spans for x in span])
                        owners.append(sorted({*new.items, *(old[0][first + d] or [])}))
                        matches = [m for m in (new.longest, tuple((old[2][first + d] or {}).values())) if m]
                        best.append(dict(zip(match.names, min(matches, key=lambda m: (-m[0], *m[1:])))) if matches else None)
                columns = list(batch.columns)
                for k, values, kind in zip(at, (counts, hit, owners, ranges, best), kinds):
                    columns[k] = pa.array(values, kind)
                yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

        return frame.mapInArrow(mark, frame.schema)

    while following is not None:
        frame = stage(marked(current), "decontaminate")
        current, following = following, next(blocks, None)
    return marked(current)


def _contaminated(prefix: str):
    hit, words_ = F.col(prefix + "hit"), F.col(prefix + "words")
    return (hit > 0) & (HIT_SHARE * hit >= words_)


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", longest: bool = False) -> DataFrame:
    """One row per document: word and hit counts, items, hit word ranges and the verdict.

    With ``longest`` also the longest match (``n_words``, ``item_id``, ``item_word``, ``doc_word``), null if there is none.
    """
    found = annotate(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), benchmark, "_", longest=longest)
    return found.select(
        "doc_id",
        F.col("_words").alias("n_words"),
        F.col("_hit").alias("n_hit"),
        F.col("_items").alias("items"),
        F.col("_ranges").alias("ranges"),
        _contaminated("_").alias("contaminated"),
        *((F.col("_longest").alias("longest"),) if longest else ()),
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    prefix = "_found_"
    while any(c.startswith(prefix) for c in docs.columns):
        prefix += "_"
    return annotate(docs, benchmark, prefix, text).filter(~_contaminated(prefix)).select(*docs.columns)


def longest_matches(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id") -> DataFrame:
    """The longest verbatim match of every benchmark suffix and all its places.

    Columns: ``item_id`` (text), ``item_word`` (position in the item), ``n_words``
    and a place ``doc_id``, ``doc_word``. Suffixes without a match of a window
    have no row. Shards give their longest matches; the longest of all remain.
    """
    rows = small_batches(docs).select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    schema = "item_id string, item_word int, n_words int, doc_id bigint, doc_word int"
    parts = []
    for items in _blocks(benchmark, item, "text", whole=True):
        shared = rows.sparkSession.sparkContext.broadcast(items)

        def find(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for first, part in slices(batch.column(1)):
                    s = shard(part, shared.value)
                    array, q, lo, hi, depth = search(s.codes, shared.value, longest=True)
                    for k, a, b, d in zip(q.tolist(), lo.tolist(), hi.tolist(), depth.tolist()):
                        at = array[a:b]
                        doc = np.searchsorted(s.first, at, side="right") - 1
                        ids = batch.column(0).take(pa.array(doc + first))
                        for owner, place in shared.value.places[k]:
                            yield pa.RecordBatch.from_arrays(
                                [
                                    pa.array([owner] * len(at)),
                                    pa.array(np.full(len(at), place, np.int32)),
                                    pa.array(np.full(len(at), d, np.int32)),
                                    ids,
                                    pa.array((at - s.first[doc]).astype(np.int32)),
                                ],
                                ["item_id", "item_word", "n_words", "doc_id", "doc_word"],
                            )

        parts.append(rows.mapInArrow(find, schema))
    if not parts:
        return rows.sparkSession.createDataFrame([], schema)
    found = parts[0]
    for more in parts[1:]:
        found = found.union(more)
    found = stage(found, "matches")
    best = found.groupBy("item_id", "item_word").agg(F.max("n_words").alias("n_words"))
    return found.join(best, ["item_id", "item_word", "n_words"], "left_semi")
