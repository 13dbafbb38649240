"""N-gram Jaccard join: documents whose shingle sets are similar enough, by PartEnum signatures.

Sets are put into bands of sizes so that similar sets lie in the same band or in neighbouring ones. Within a band,
similar sets differ in at most k elements. The feature domain is cut into a few more than k + 1 parts, each set has one
signature per part, and similar sets share a part's signature: a difference spoils one part at most. Documents with a
common signature are compared by their whole sets.

A part without elements says little. Similar sets agree in more parts than k leaves over, so empty parts count only for
a set in which as many parts are empty.

Copies with the same set are represented by the smallest id. Members of a small group with a common signature are all
compared. In a large group they are compared with its most central member first, the one that shares most signatures with
others, and among each other only where that left them in different components and where a sketch of the sets, whose
bits bound the difference from below, allows for a link. So no link between different texts is lost.

Null and empty texts have an empty set and no links. A row without id is returned without component. Rows that repeat an
id are one document with several texts: all of them may link it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.components import components
from corpusloom.llm.flat import LOWER, give_back, gram_hashes, mix, prefix_sums, range_hash, ranges, slices, word_hashes, words
from corpusloom.session import materialize, width

#: Words of a shingle, and the similarity from which documents link, in hundredths.
WORDS, PERCENT = 5, 80
#: All members of a group up to this size are compared with each other.
SMALL = 8
#: Signatures of a bucket: what one task holds at once.
BUCKET = 4_000_000
#: Ids that may be sent to all tasks.
SENT_IDS = 1_000_000
#: Words of 64 bits in a sketch, whose bit i is the parity of the shingles that fall on it; the wide one folds into the other.
SKETCH, WIDE = 16, 64
#: Sets whose sketches are counted at a time.
SKETCHED = 2048


def shingle_sets(data: np.ndarray, where: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of every text, as sorted hashes, and where each text's begin (one more at the end)."""
    data = LOWER[data]
    begins, ends, before = words(data, where)
    hashes, count = word_hashes(data, begins, ends), np.diff(before)
    long, short = np.flatnonzero(count >= size), np.flatnonzero((count > 0) & (count < size))
    several = count[long] - size + 1
    keys = np.concatenate([gram_hashes(hashes, size)[ranges(before[long], several)], range_hash(prefix_sums(hashes), before[short], before[short + 1])])
    rows = np.concatenate([np.repeat(long, several), short])
    order = np.lexsort((keys, rows))
    keys, rows = keys[order], rows[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (rows[1:] != rows[:-1])
    return keys[new], np.searchsorted(rows[new], np.arange(len(where)))


class Bands:
    """Bands of set sizes, with the number of parts and the allowed differences of each."""

    def __init__(self, percent: int):
        self.percent = percent
        self.upper = [0]

    def prepare(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Upper ends, differences and parts of the bands up to one that is two above ``size``."""
        upper = self.upper
        while len(upper) < 3 or upper[-3] < size:
            upper.append((upper[-1] + 1) * 100 // self.percent)
        ends = np.array(upper, np.int64)
        # |A xor B| <= (|A| + |B|) * (100 - percent) / (100 + percent), and both are as large as the band allows at most.
        differ = 2 * ends * (100 - self.percent) // (100 + self.percent)
        return ends, differ, np.where(differ == 0, 1, differ + 3 + differ // 16)

    def signatures(self, keys: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Signatures of all sets and the set of each."""
        sizes = np.diff(where)
        full = np.flatnonzero(sizes)
        if not len(full):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        ends, differ, parts = self.prepare(int(sizes.max()))
        own = np.searchsorted(ends, sizes[full])
        spread, summand = mix(keys ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32), mix(keys + np.uint64(0x14057B7EF767814F))
        out, owners = [], []
        # A set belongs to its own band and, as a smaller partner, to the next.
        for band in (own, own + 1):
            slots = parts[band]
            first = np.cumsum(slots) - slots
            at = np.repeat(first, sizes[full]) + (spread % np.repeat(slots, sizes[full]).astype(np.uint64)).astype(np.int64)
            sums, filled = np.zeros(int(slots.sum()), np.uint64), np.zeros(int(slots.sum()), bool)
            np.add.at(sums, at, summand)
            filled[at] = True
            owner = np.repeat(np.arange(len(full)), slots)
            empty = slots - np.add.reduceat(filled, first, dtype=np.int64)
            kept = filled | (empty >= slots - differ[band])[owner]
            part = np.arange(len(owner)) - first[owner]
            out.append(mix(sums ^ mix((np.repeat(band, slots).astype(np.uint64) << np.uint64(32)) | part.astype(np.uint64)))[kept])
            owners.append(full[owner[kept]])
        return np.concatenate(out), np.concatenate(owners)


def documents_of(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(F.col(id_column).cast("long").alias("doc"), F.col(text_column).alias("text"))


def digests(keys: np.ndarray, ends: np.ndarray, salt: int) -> np.ndarray:
    """A number for each set that does not depend on the order of its elements."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(keys ^ np.uint64(salt)))])
    return mix(sums[ends[1:]] - sums[ends[:-1]] + np.diff(ends).astype(np.uint64))


def parities(places: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each set the parity of the elements at every place, as bits: one byte per place and set while they are counted."""
    rows = len(ends) - 1
    bits = np.zeros((rows, 64 * WIDE), np.uint8)
    np.add.at(bits, (np.repeat(np.arange(rows), np.diff(ends)), places[ends[0] : ends[-1]]), 1)
    return np.packbits(bits & 1, axis=1).view(np.int64)


def described(docs: DataFrame, size: int) -> DataFrame:
    """Size, digest and sketch of the set of each row."""

    def describe(batches):
        for batch in batches:
            for some, data, where in slices(batch, "text"):
                keys, ends = shingle_sets(data, where, size)
                places = (mix(keys ^ np.uint64(3)) % np.uint64(64 * WIDE)).astype(np.int64)
                wide = np.concatenate([parities(places, ends[a : a + SKETCHED + 1]) for a in range(0, some.num_rows, SKETCHED)])
                folded = np.bitwise_xor.reduce(wide.reshape(some.num_rows, WIDE // SKETCH, SKETCH), axis=1)
                lists = [pa.ListArray.from_arrays(pa.array(np.arange(some.num_rows + 1) * size, pa.int32()), pa.array(words.ravel())) for size, words in ((SKETCH, folded), (WIDE, wide))]
                yield pa.record_batch([some.column("doc"), pa.array(np.diff(ends)), *(pa.array(digests(keys, ends, salt).view(np.int64)) for salt in (1, 2)), *lists], ["doc", "n_shingles", "digest1", "digest2", "sketch", "wide"])
        give_back()

    return docs.mapInArrow(describe, "doc long, n_shingles long, digest1 long, digest2 long, sketch array<long>, wide array<long>")


KINDS = "kind int, bucket long, signatures binary, docs binary, hot binary"
NAMES = ["kind", "bucket", "signatures", "docs", "hot"]


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (keys >> np.uint64(32)) % np.uint64(buckets)


def group_ids(keys: np.ndarray, bucket: np.ndarray | int) -> np.ndarray:
    """A number for the lower half of a signature in its bucket."""
    low = (keys.astype(np.uint64) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    return (low << 31) ^ np.asarray(bucket).astype(np.int64)


def packed(docs: DataFrame, size: int, percent: int, buckets: int) -> DataFrame:
    """Signatures by bucket, many to a row.

    Where more than ``SMALL`` texts of a slice share a signature, all are listed as members of a large group (kind 1),
    and only the first goes to the bucket, marked as one of many.
    """

    def pack(batches):
        bands = Bands(percent)
        for batch in batches:
            for some, data, where in slices(batch, "text"):
                ids = some.column("doc").to_numpy(zero_copy_only=False)
                # Copies with the same set are known by their digests; the first of a slice speaks for all.
                shingles, ends = shingle_sets(data, where, size)
                digest = digests(shingles, ends, 1)
                order = np.lexsort((ids, digest))
                single = np.zeros(len(ids), bool)
                single[order[np.unique(digest[order], return_index=True)[1]]] = True
                sizes = np.diff(ends)
                keys, rows = bands.signatures(shingles[np.repeat(single, sizes)], np.concatenate([[0], np.cumsum(np.where(single, sizes, 0))]))
                order = np.lexsort((ids[rows], keys))
                keys, owner = keys[order], ids[rows[order]]
                begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
                count = np.diff(np.append(begins, len(keys)))
                many = count > SMALL
                if many.any():
                    members = ranges(begins[many], count[many])
                    groups = group_ids(keys[members], bucket_of(keys[members], buckets))
                    listed = [pa.array([1], pa.int32()), pa.array(owner[members[:1]]), pa.array([groups.tobytes()]), pa.array([owner[members].tobytes()]), pa.array([None], pa.binary())]
                    yield pa.record_batch(listed, NAMES)
                hot = np.zeros(len(keys), bool)
                hot[begins[many]] = True
                kept = hot | ~np.repeat(many, count)
                keys, owner, hot = keys[kept], owner[kept], hot[kept]
                bucket = bucket_of(keys, buckets)
                order = np.lexsort((owner, bucket))
                keys, owner, hot, bucket = keys[order].astype(np.uint32), owner[order], hot[order], bucket[order]
                names, begins = np.unique(bucket, return_index=True)
                cuts = [*begins[1:], len(keys)]
                # Ids rise within a bucket; their differences are mostly 0 and compress well.
                parts = [(keys[a:b].tobytes(), np.diff(owner[a:b], prepend=0).tobytes(), np.packbits(hot[a:b]).tobytes()) for a, b in zip(begins, cuts, strict=False)]
                n = len(names)
                yield pa.record_batch(
                    [pa.array(np.full(n, 2, np.int32)), pa.array(names.astype(np.int64))] + [pa.array([p[j] for p in parts], pa.binary()) for j in range(3)],
                    NAMES,
                )
        give_back()

    return docs.where("doc is not null").mapInArrow(pack, KINDS)


def grouped(rows: DataFrame) -> DataFrame:
    """Candidate pairs (kind 0) and members of large groups (kind 1) from the buckets."""

    def group(batches):
        bucket, blobs = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["kind"] == 1:
                    yield from two(1, np.stack([np.frombuffer(row["signatures"], np.int64), np.frombuffer(row["docs"], np.int64)], axis=1))
                    continue
                if blobs and row["bucket"] != bucket:
                    yield from judged(bucket, blobs)
                    blobs = []
                bucket = row["bucket"]
                blobs.append((row["signatures"], row["docs"], row["hot"]))
        if blobs:
            yield from judged(bucket, blobs)
        give_back()

    def judged(bucket, some):
        keys = np.concatenate([np.frombuffer(s, np.uint32) for s, _, _ in some])
        docs = np.concatenate([np.cumsum(np.frombuffer(d, np.int64)) for _, d, _ in some])
        hot = np.concatenate([np.unpackbits(np.frombuffer(h, np.uint8), count=len(s) // 4).astype(bool) for s, _, h in some])
        order = np.lexsort((docs, keys))
        keys, docs, hot = keys[order], docs[order], hot[order]
        begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        count = np.diff(np.append(begins, len(keys)))
        large = (count > SMALL) | np.logical_or.reduceat(hot, begins)
        found = []
        for distance in range(1, SMALL):
            # The pairs of small groups, by the distance of their members.
            wide = ~large & (count > distance)
            first = ranges(begins[wide], count[wide] - distance)
            found.append(np.stack([docs[first], docs[first + distance]], axis=1))
        pairs = np.unique(np.concatenate(found), axis=0)
        yield from two(0, pairs[pairs[:, 0] != pairs[:, 1]])
        members = ranges(begins[large], count[large])
        yield from two(1, np.stack([group_ids(keys[members], bucket), docs[members]], axis=1))

    # Whole buckets, one after the other: a task holds one at a time.
    return rows.repartition("bucket").sortWithinPartitions("kind", "bucket").mapInArrow(group, "kind int, a long, b long")


def two(kind: int, pairs: np.ndarray):
    for first in range(0, len(pairs), 100_000):
        some = pairs[first : first + 100_000]
        yield pa.record_batch([pa.array(np.full(len(some), kind, np.int32)), pa.array(some[:, 0]), pa.array(some[:, 1])], ["kind", "a", "b"])


def set_table(docs: DataFrame, size: int) -> DataFrame:
    """The shingles of each row as an array."""

    def keep(batches):
        for batch in batches:
            for some, data, where in slices(batch, "text"):
                keys, ends = shingle_sets(data, where, size)
                shingles = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys.view(np.int64)))
                yield pa.record_batch([some.column("doc"), shingles], ["doc", "shingles"])
        give_back()

    return docs.mapInArrow(keep, "doc long, shingles array<long>")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (home, doc) whose sets are similar enough, as links (a, b). A home may have any number of pairs."""
    here = pairs.join(sets.select("doc", F.col("shingles").alias("mine")), "doc")
    there = sets.select(F.col("doc").alias("home"), F.col("shingles").alias("other"))
    common = F.size(F.array_intersect("mine", "other"))
    similar = 100 * common >= percent * (F.size("mine") + F.size("other") - common)
    return here.join(there, "home").where(similar).select(F.col("home").alias("a"), F.col("doc").alias("b")).distinct()


def may_link(n1: str, n2: str, words: list[tuple[Column, Column]], percent: int) -> Column:
    """Whether sizes and sketches allow for the similarity: bits that differ are elements that differ."""
    differ = sum((F.bit_count(a.bitwiseXOR(b)) for a, b in words), F.lit(0))
    sizes = 100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)
    return sizes & ((100 + percent) * differ <= (100 - percent) * (F.col(n1) + F.col(n2)))


def comparable(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sizes and sketches allow for the similarity, each once."""
    mine = sketches.select("doc", F.col("n").alias("n1"), F.col("wide").alias("s1"))
    other = sketches.select(F.col("doc").alias("home"), F.col("n").alias("n2"), F.col("wide").alias("s2"))
    words = [(F.element_at("s1", i + 1), F.element_at("s2", i + 1)) for i in range(WIDE)]
    met = pairs.where("home != doc").join(mine, "doc").join(other, "home")
    return met.where(may_link("n1", "n2", words, percent)).select("home", "doc").distinct()


def central_pairs(members: DataFrame) -> DataFrame:
    """Each member of a large group with the most central one: the one whose groups have most members in all."""
    sizes = members.groupBy("grp").agg(F.count("doc").alias("size"))
    central = members.join(sizes, "grp").groupBy("doc").agg(F.sum("size").alias("rank"))
    ranked = members.join(central, "doc")
    homes = ranked.groupBy("grp").agg(F.max(F.struct(F.col("rank"), (-F.col("doc")).alias("last"))).alias("best")).select("grp", (-F.col("best.last")).alias("home"))
    return members.join(homes, "grp").select("home", "doc").where("home != doc").distinct()


def unsettled(members: DataFrame, known: DataFrame) -> DataFrame:
    """Members of groups that are not yet in one component: grp, doc, component."""
    labelled = members.join(known, members.doc == known.id, "left").select("grp", "doc", F.coalesce("component", "doc").alias("component"))
    labelled = materialize(labelled, "members")
    open_groups = labelled.groupBy("grp").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("grp")
    return labelled.join(open_groups, "grp")


def crossing_pairs(members: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs of members from different components whose sets may be similar, by size and sketch."""
    words = [f"s{i}" for i in range(SKETCH)]
    mine = members.join(sketches, "doc").select("grp", "doc", "component", "n", *(F.element_at("sketch", i + 1).alias(w) for i, w in enumerate(words)))
    mine = materialize(mine, "unsettled")
    other = mine.select("grp", *(F.col(c).alias(f"{c}_2") for c in ("doc", "component", "n", *words)))
    similar = may_link("n", "n_2", [(F.col(w), F.col(f"{w}_2")) for w in words], percent)
    pairs = mine.join(other, (mine.grp == other.grp) & (F.col("component") < F.col("component_2")) & similar)
    return pairs.select(F.col("doc_2").alias("home"), "doc").distinct()


def sets_of(pairs: DataFrame, rows: DataFrame, size: int) -> DataFrame:
    """The shingle sets of the documents of some pairs."""
    needed = materialize(pairs.select("doc").union(pairs.select("home")).distinct(), "needed")
    # So many ids are few bytes for every task; beyond that the join shuffles the texts.
    few = F.broadcast(needed) if needed.count() <= SENT_IDS else needed
    return materialize(set_table(rows.join(few, "doc", "left_semi"), size), "shingles")


def linked(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = WORDS, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Set sizes by row (doc, n_shingles), and the component of each document that has a link (id, component)."""
    spark = docs.sparkSession
    rows = documents_of(docs, id_column, text_column)
    info = materialize(described(rows, size), "sets")
    filled = info.where("n_shingles > 0 and doc is not null")
    same = ["n_shingles", "digest1", "digest2"]
    firsts = filled.groupBy(same).agg(F.min("doc").alias("rep"))
    reps = materialize(filled.join(firsts, same).select("doc", "rep", F.col("n_shingles").alias("n"), "sketch", "wide").distinct(), "representatives")
    total = reps.agg(F.sum("n")).first()[0] or 0
    buckets = max(4 * width(spark), total // BUCKET + 1)
    found = materialize(grouped(packed(rows, size, percent, buckets)), "candidates")
    mine, other = reps.select(F.col("doc").alias("b"), F.col("rep").alias("doc")), reps.select(F.col("doc").alias("a"), F.col("rep").alias("home"))
    pairs = found.where("kind = 0").join(mine, "b").join(other, "a").select("home", "doc").distinct()
    sketches = reps.where("doc = rep").select("doc", "n", "sketch", "wide")
    members = materialize(found.where("kind = 1").select(F.col("a").alias("grp"), F.col("b")).join(mine, "b").select("grp", "doc").distinct(), "members")
    pairs = materialize(comparable(pairs.union(central_pairs(members)), sketches, percent), "pairs")
    copies = reps.where("doc != rep").select(F.col("rep").alias("a"), F.col("doc").alias("b"))
    links = materialize(verified(pairs, sets_of(pairs, rows, size), percent).union(copies), "links")
    known = components(links)
    crossing = crossing_pairs(unsettled(members, known), sketches, percent)
    more = materialize(comparable(crossing, sketches, percent).exceptAll(pairs), "pairs")
    # Most of these pairs fail as well; the components change only if one does not.
    found = materialize(verified(more, sets_of(more, rows, size), percent), "links") if not more.isEmpty() else None
    if found is not None and not found.isEmpty():
        known = components(links.union(found))
    return info.select("doc", "n_shingles"), known


def jaccard_components(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """For each row: id, n_shingles, and component_id, the smallest id that links lead to."""
    info, found = linked(docs, id_column, text_column, size, percent)
    joined = info.join(found, info.doc == found.id, "left")
    return joined.select(F.col("doc").alias(id_column), "n_shingles", F.coalesce("component", "doc").alias("component_id"))


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The documents with the smallest id of their component, with all their columns, and those without id."""
    _, found = linked(docs, id_column, text_column, size, percent)
    found = found.where("id != component").select(F.col("id").alias("_copy"))
    return docs.join(found, docs[id_column].cast("long") == found["_copy"], "left_anti")
