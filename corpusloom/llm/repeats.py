"""Windows that repeat across a corpus: what suffix trees over words and suffix arrays over bytes share.

A window is a fixed number of units, words or bytes. Each window has an anchor, the smallest hash among the shorter grams
in it, so equal windows have equal anchors at the same place. Anchors are counted over the whole corpus first, a few bytes
each. Windows whose anchor occurs once cannot repeat; the others are sent, as the stretch of text around their anchor, to
the bucket of that anchor, where all windows equal to them arrive too. Buckets grow in number with the corpus.

Before anything is sent, equal stretches of a slice are reduced to the first: the windows of all later ones are repeats
already. So a passage that stands in very many documents reaches its bucket once per slice.

What is removed is decided on the input: every unit that a window covers which also starts earlier. Null and empty texts
have no windows. Rows without id come back whole and count for no other. Equal rows that repeat an id do not stand before
each other.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.flat import _BYTE_CODES, gram_hashes, leftmost_minima, mix, prefix_sums, range_hash, ranges, slices, word_hashes, words
from corpusloom.llm.shingle_join import bucket_of, group_ids
from corpusloom.session import materialize, width

#: Anchors that a bucket holds on average at most, and bytes of the corpus for each bucket of stretches.
ANCHORS, TEXT = 4_000_000, 2 << 20

PARTS = "kind int, doc long, version long, low long, high long, bucket long, keys binary, docs binary, versions binary, starts binary, sizes binary, content binary, flags binary"
NAMES = [part.split()[0] for part in PARTS.split(", ")]


@dataclass
class Windows:
    """What a window is: so many words or bytes, and the grams that may be its anchor."""

    size: int
    gram: int
    by_words: bool

    def units(self, data: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A number for every unit, where each text's begin (one more at the end), first byte and end of each unit."""
        if self.by_words:
            begins, ends, before = words(data, where)
            return word_hashes(data, begins, ends), before, begins, ends
        at = np.arange(len(data) + 1)
        return _BYTE_CODES[data], where, at[:-1], at[1:]

    def runs(self, values: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, ...]:
        """Runs of windows with the same anchor: text, first and last window, hash of the anchor."""
        several = np.maximum(np.diff(before) - self.size + 1, 0)
        owner, starts = np.repeat(np.arange(len(several)), several), ranges(before[:-1], several)
        if not len(starts):
            return owner, starts, starts, np.zeros(0, np.uint64)
        grams = gram_hashes(values, self.gram)
        anchor = leftmost_minima(grams, self.size - self.gram + 1)[starts]
        new = np.ones(len(starts), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
        first = np.flatnonzero(new)
        return owner[first], starts[first], starts[np.append(first[1:], len(starts)) - 1], grams[anchor[first]]


def batch_of(n: int, **columns) -> pa.RecordBatch:
    """A batch with the given columns; the others are null."""
    kinds = {"kind": pa.int32()} | dict.fromkeys(("doc", "version", "low", "high", "bucket"), pa.int64())
    return pa.record_batch([pa.array(columns[name], kinds.get(name, pa.binary())) if name in columns else pa.nulls(n, kinds.get(name, pa.binary())) for name in NAMES], NAMES)


def firsts(*keys: np.ndarray) -> np.ndarray:
    """Where a combination of sorted keys begins."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new)


def replies(docs: np.ndarray, keys: np.ndarray):
    """Repeated anchors by document."""
    order = np.lexsort((keys, docs))
    docs, keys = docs[order], keys[order]
    cuts = [*firsts(docs), len(docs)]
    for first in range(0, len(cuts) - 1, 5000):
        some = cuts[first : first + 5001]
        yield batch_of(len(some) - 1, kind=np.zeros(len(some) - 1, np.int32), doc=docs[some[:-1]], bucket=docs[some[:-1]], keys=[keys[a:b].tobytes() for a, b in zip(some, some[1:], strict=False)])


def anchors(rows: DataFrame, windows: Windows, buckets: int) -> DataFrame:
    """Anchors by bucket (kind 1). Those that repeat within a slice are known at once (kind 0); the first goes on, marked."""

    def pack(batches):
        for batch in batches:
            for some, data, where in slices(batch, "text"):
                values, before, _, _ = windows.units(data, where)
                owner, _, _, keys = windows.runs(values, before)
                docs = some.column("doc").to_numpy()[owner]
                order = np.lexsort((docs, keys))
                keys, docs = keys[order], docs[order]
                if not len(keys):
                    continue
                groups = firsts(keys)
                count = np.diff(np.append(groups, len(keys)))
                marked = np.repeat(count > 1, count)
                if windows.by_words:
                    # Repeats inside one document are none.
                    marked &= np.repeat(docs[groups] != docs[groups + count - 1], count)
                bucket = bucket_of(keys, buckets)
                yield from replies(docs[marked], group_ids(keys[marked], bucket[marked]))
                sent = ~marked
                sent[groups] = True
                keys, docs, bucket, marked = keys[sent], docs[sent], bucket[sent], marked[sent]
                order = np.lexsort((docs, bucket))
                keys, docs, bucket, marked = keys[order].astype(np.uint32), docs[order], bucket[order], marked[order]
                cuts = [*firsts(bucket), len(bucket)]
                spans = list(zip(cuts, cuts[1:], strict=False))
                yield batch_of(
                    len(spans), kind=np.ones(len(spans), np.int32), bucket=bucket[cuts[:-1]].astype(np.int64), keys=[keys[a:b].tobytes() for a, b in spans],
                    docs=[np.diff(docs[a:b], prepend=0).tobytes() for a, b in spans], flags=[np.packbits(marked[a:b]).tobytes() for a, b in spans],
                )

    def meet(batches):
        blobs: dict[int, list[dict]] = {}
        for batch in batches:
            kind = batch.column("kind").to_numpy()
            plain = batch.filter(pa.array(kind == 0))
            if plain.num_rows:
                yield plain.select(["doc", "keys"])
            for row in batch.filter(pa.array(kind == 1)).select(["bucket", "keys", "docs", "flags"]).to_pylist():
                blobs.setdefault(row.pop("bucket"), []).append(row)
        for bucket in list(blobs):
            some = blobs.pop(bucket)
            keys = np.concatenate([np.frombuffer(r["keys"], np.uint32) for r in some])
            docs = np.concatenate([np.cumsum(np.frombuffer(r["docs"], np.int64)) for r in some])
            marked = np.concatenate([np.unpackbits(np.frombuffer(r["flags"], np.uint8), count=len(r["keys"]) // 4) for r in some]).astype(bool)
            order = np.lexsort((docs, keys))
            keys, docs, marked = keys[order], docs[order], marked[order]
            groups = firsts(keys)
            count = np.diff(np.append(groups, len(keys)))
            again = np.repeat((count > 1) | np.logical_or.reduceat(marked, groups), count) & ~marked
            for reply in replies(docs[again], group_ids(keys[again], bucket)):
                yield reply.select(["doc", "keys"])

    packed = rows.select("doc", "text").mapInArrow(pack, PARTS).select("kind", "doc", "bucket", "keys", "docs", "flags")
    return packed.repartition("bucket").mapInArrow(meet, "doc long, keys binary")


def stretches(rows: DataFrame, windows: Windows, buckets: int, text_buckets: int) -> DataFrame:
    """Stretches with a repeated anchor by bucket (kind 1), and repeats that are known within a slice (kind 0)."""

    def cut(batches):
        for batch in batches:
            for some, data, where in slices(batch, "text"):
                values, before, begins, ends = windows.units(data, where)
                owner, low, high, keys = windows.runs(values, before)
                known = [np.frombuffer(b"".join(k), np.int64) for k in some.column("known").to_pylist()]
                asked = mix(np.concatenate(known).view(np.uint64) ^ mix(np.repeat(np.arange(len(known)), [len(k) for k in known]).astype(np.uint64)))
                group = group_ids(keys, bucket_of(keys, buckets))
                kept = np.isin(mix(group.view(np.uint64) ^ mix(owner.astype(np.uint64))), asked)
                owner, low, high, group = owner[kept], low[kept], high[kept] + windows.size, group[kept]
                docs, versions = some.column("doc").to_numpy()[owner], some.column("version").to_numpy()[owner]
                starts = low - before[owner]
                content = range_hash(prefix_sums(values), low, high)
                later, _ = later_copies(windows, content, docs, starts)
                yield from spans(docs[later], versions[later], starts[later], starts[later] + (high - low)[later])
                bucket = (mix(group.view(np.uint64)) % np.uint64(text_buckets)).astype(np.int64)
                order = np.lexsort((starts, docs, bucket))
                order = order[~later[order]]
                docs, versions, starts, low, high, bucket, group = docs[order], versions[order], starts[order], low[order], high[order], bucket[order], group[order]
                first, size = begins[low], ends[high - 1] - begins[low]
                edges = [*firsts(bucket), len(bucket)]
                parts = list(zip(edges, edges[1:], strict=False))
                for part in range(0, len(parts), 64):
                    some_parts = parts[part : part + 64]
                    yield batch_of(
                        len(some_parts), kind=np.ones(len(some_parts), np.int32), bucket=[int(bucket[a]) for a, _ in some_parts], keys=[group[a:b].tobytes() for a, b in some_parts],
                        docs=[np.diff(docs[a:b], prepend=0).tobytes() for a, b in some_parts], versions=[versions[a:b].tobytes() for a, b in some_parts], starts=[starts[a:b].tobytes() for a, b in some_parts],
                        sizes=[size[a:b].tobytes() for a, b in some_parts], content=[data[ranges(first[a:b], size[a:b])].tobytes() for a, b in some_parts],
                    )

    return rows.mapInArrow(cut, PARTS)


def later_copies(windows: Windows, content: np.ndarray, docs: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which stretches have an equal one before them, and the first of each stretch's equals."""
    order = np.lexsort((starts, docs, content))
    groups = firsts(content[order])
    first = np.repeat(order[groups], np.diff(np.append(groups, len(order))))
    later = np.zeros(len(content), bool)
    later[order] = docs[order] > docs[first]
    if not windows.by_words:
        later[order] |= (docs[order] == docs[first]) & (starts[order] > starts[first])
    back = np.zeros(len(content), np.int64)
    back[order] = first
    return later, back


def spans(docs: np.ndarray, versions: np.ndarray, low: np.ndarray, high: np.ndarray):
    """Runs of units to remove; those of a text that touch are made one."""
    if not len(docs):
        return
    order = np.lexsort((low, versions, docs))
    docs, versions, low, high = docs[order], versions[order], low[order], high[order]
    begin = np.zeros(len(docs), bool)
    begin[firsts(docs, versions)] = True
    shift = np.cumsum(begin) << 40
    reach = np.maximum.accumulate(high + shift) - shift
    begin[1:] |= low[1:] > reach[:-1]
    first = np.flatnonzero(begin)
    docs, versions, low, high = docs[first], versions[first], low[first], reach[np.append(first[1:], len(order)) - 1]
    for at in range(0, len(docs), 50_000):
        some = slice(at, at + 50_000)
        yield batch_of(len(docs[some]), kind=np.zeros(len(docs[some]), np.int32), doc=docs[some], version=versions[some], low=low[some], high=high[some], bucket=docs[some])


def repeated(rows: DataFrame, windows: Windows, classes: Callable) -> DataFrame:
    """Runs of units to remove: doc, version, low, high. ``classes`` gives equal numbers to equal windows of a bucket."""

    def meet(batches):
        blobs: dict[int, list[dict]] = {}
        for batch in batches:
            kind = batch.column("kind").to_numpy()
            plain = batch.filter(pa.array(kind == 0))
            if plain.num_rows:
                yield plain.select(["doc", "version", "low", "high"])
            for row in batch.filter(pa.array(kind == 1)).select(["bucket", "docs", "versions", "starts", "sizes", "content"]).to_pylist():
                blobs.setdefault(row.pop("bucket"), []).append(row)
        for bucket in list(blobs):
            some = blobs.pop(bucket)
            docs = np.concatenate([np.cumsum(np.frombuffer(r["docs"], np.int64)) for r in some])
            versions, starts, sizes = (np.concatenate([np.frombuffer(r[name], np.int64) for r in some]) for name in ("versions", "starts", "sizes"))
            data = np.frombuffer(b"".join(r["content"] for r in some), np.uint8)
            for part in judged(windows, classes, docs, versions, starts, sizes, data):
                yield part.select(["doc", "version", "low", "high"])

    return rows.repartition("bucket").mapInArrow(meet, "doc long, version long, low long, high long")


def judged(windows: Windows, classes: Callable, docs: np.ndarray, versions: np.ndarray, starts: np.ndarray, sizes: np.ndarray, data: np.ndarray):
    """The repeats among the stretches of a bucket."""
    where = np.concatenate([[0], np.cumsum(sizes)])
    values, before, _, _ = windows.units(data, where)
    content = range_hash(prefix_sums(values), before[:-1], before[1:])
    later, first = later_copies(windows, content, docs, starts)
    units = np.diff(before)
    yield from spans(docs[later], versions[later], starts[later], (starts + units)[later])
    # Different stretches only; equal ones that stand before each other in no order share the outcome of the first.
    single = np.flatnonzero(first == np.arange(len(docs)))
    if len(single) < 2 and windows.by_words:
        return
    chosen = ranges(where[single], sizes[single])
    inner = np.concatenate([[0], np.cumsum(sizes[single])])
    text, edges = data[chosen], inner
    values, before, _, _ = windows.units(text, edges)
    several = np.diff(before) - windows.size + 1
    owner, at = np.repeat(np.arange(len(single)), several), ranges(before[:-1], several)
    place = at - before[owner]
    number = classes(windows, text, edges, values, before, at)
    doc = docs[single][owner]
    start = np.zeros(len(doc), np.int64) if windows.by_words else starts[single][owner] + place
    order = np.lexsort((start, doc, number))
    groups = firsts(number[order])
    head = np.repeat(order[groups], np.diff(np.append(groups, len(order))))
    gone = np.zeros(len(order), bool)
    gone[order] = (doc[order] != doc[head]) | (start[order] != start[head])
    hit = np.flatnonzero(gone)
    if not len(hit):
        return
    new = np.ones(len(hit), bool)
    new[1:] = (np.diff(hit) > 1) | (owner[hit][1:] != owner[hit][:-1])
    begin, end = hit[new], hit[np.append(np.flatnonzero(new)[1:], len(hit)) - 1]
    low, high = place[begin], place[end] + windows.size
    mine = single[owner[begin]]
    yield from spans(docs[mine], versions[mine], starts[mine] + low, starts[mine] + high)
    twins = np.flatnonzero(~later & (first != np.arange(len(docs))))
    if len(twins):
        by_first: dict[int, list[int]] = {}
        for twin in twins:
            by_first.setdefault(int(first[twin]), []).append(int(twin))
        pairs = [(twin, run) for run, stretch in enumerate(mine) for twin in by_first.get(int(stretch), ())]
        if pairs:
            twin, run = (np.array(x) for x in zip(*pairs, strict=True))
            yield from spans(docs[twin], versions[twin], starts[twin] + low[run], starts[twin] + high[run])


def without_repeats(docs: DataFrame, windows: Windows, classes: Callable, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """For each row: id, n_units, n_removed, n_spans (runs removed) and kept, the bytes that are left.

    Kept words are joined by one blank; kept bytes are strung together.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(F.col(id_column).cast("long").alias("doc"), text.alias("text"), F.xxhash64(text).alias("version"))
    known = rows.where("doc is not null")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    units = total // 6 if windows.by_words else total
    buckets = max(4 * width(spark), 2 * units // (windows.size - windows.gram + 2) // ANCHORS + 1)
    asked = anchors(known, windows, buckets).groupBy("doc").agg(F.collect_list("keys").alias("known"))
    sent = stretches(known.join(asked, "doc"), windows, buckets, max(2 * width(spark), total // TEXT + 1))
    found = repeated(sent, windows, classes)
    runs = found.groupBy("doc", "version").agg(F.collect_list(F.struct("low", "high")).alias("runs"))

    def keep(batches):
        for batch in batches:
            for some, data, where in slices(batch, "text"):
                _, before, begins, ends = windows.units(data, where)
                change = np.zeros(int(before[-1]) + 1, np.int64)
                runs = some.column("runs")
                if runs.null_count < len(runs):
                    owner = np.repeat(np.arange(len(runs)), runs.value_lengths().fill_null(0).to_numpy())
                    parts = runs.flatten()
                    np.add.at(change, parts.field("low").to_numpy() + before[owner], 1)
                    np.add.at(change, parts.field("high").to_numpy() + before[owner], -1)
                gone = np.cumsum(change[:-1]) > 0
                removed = np.concatenate([[0], np.cumsum(gone)])
                starts = gone.copy()
                starts[1:] &= ~gone[:-1]
                # A run ends with its text.
                heads = before[:-1][np.diff(before) > 0]
                starts[heads] = gone[heads]
                opened = np.concatenate([[0], np.cumsum(starts)])
                left = np.flatnonzero(~gone)
                sizes = (ends - begins)[left]
                if windows.by_words:
                    out = np.full(int((sizes + 1).sum()), 0x20, np.uint8)
                    to = np.cumsum(sizes + 1) - sizes - 1
                    out[ranges(to, sizes)] = data[ranges(begins[left], sizes)]
                    cuts = np.concatenate([to, [len(out)]])[np.searchsorted(left, before)]
                    content = [out[a : max(a, b - 1)].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]
                else:
                    cuts = np.searchsorted(left, before)
                    out = data[left]
                    content = [out[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]
                numbers = [np.diff(before), removed[before[1:]] - removed[before[:-1]], opened[before[1:]] - opened[before[:-1]]]
                yield pa.record_batch([some.column("doc"), *map(pa.array, numbers), pa.array(content, pa.binary())], ["doc", "n_units", "n_removed", "n_spans", "kept"])

    marked = rows.join(materialize(runs, "runs"), ["doc", "version"], "left").select("doc", "text", "runs")
    return marked.mapInArrow(keep, "doc long, n_units long, n_removed long, n_spans long, kept binary").withColumnRenamed("doc", id_column)
