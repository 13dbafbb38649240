"""BPE training as an iterative DataFrame job.

The words are written once per generation, indexed by the pairs that they contain. The driver follows the counts of
the leading pairs and takes some of the best ones that do not touch each other. One job then reads the words that have these pairs in
the index, brings each up to date with the merges since the generation began, and sums up how every merge changes the
counts of all pairs. With these sums the driver replays the merges one by one; as soon as another pair has become the best one,
the rest is dropped and looked at anew. So each merge is the one that a recount would give, and a round costs what its words cost.

A pair's count is largest when the younger of its tokens appears, and only falls after that. So pairs that were behind
the followed ones when the generation began stay behind, and a new pair is followed if it begins before them.
"""

from __future__ import annotations

import sys
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from heapq import heapify, heappop, heappush, nsmallest

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import sequences as S
from corpusloom.functions.patterns import GPT4_PATTERN
from corpusloom.operators import pairs as P
from corpusloom.session import materialize, width

# Pairs whose counts the driver follows.
FOLLOWED = 1 << 16
# Merges tried in one round, and merges after which the words are written anew.
ROUND_MERGES = 64
GENERATION_MERGES = 96
# Longer words are not listed by their pairs, but looked at in every round.
INDEXED_LENGTH = 64
# Long words are joined to strings of so many symbols, and counted densely if these have so many different ones.
JOINED_LENGTH = 1 << 20
DENSE_SYMBOLS = 1 << 10
# A generation is indexed when a round of the one before changed less than one word in so many.
INDEX_SHARE = 16
# Equally frequent pairs whose first places one job compares.
LISTED_TIES = 1 << 10
# What is shipped to the tasks names no module of this package.
BREAK = S.BREAK


@dataclass(frozen=True)
class TrainedMerge:
    rank: int
    a: int
    b: int
    new_id: int
    cnt: int


MERGES_SCHEMA = "rank int, a int, b int, new_id int, cnt long"


def merges_frame(spark: SparkSession, merges: list[TrainedMerge]) -> DataFrame:
    """Merges as a table; it has at most as many rows as the vocabulary."""
    rows = [(m.rank, m.a, m.b, m.new_id, m.cnt) for m in merges]
    return spark.createDataFrame(rows, MERGES_SCHEMA)


def train_bpe(
    docs: DataFrame,
    vocab_size: int,
    pattern: str | None = GPT4_PATTERN,
    text: str = "text",
    tie: str = "smallest",
    order: str | None = None,
    batch: bool = True,
) -> list[TrainedMerge]:
    """Learn ``vocab_size - 256`` merges, or fewer when no pair is left.

    ``tie`` decides between equally frequent pairs: ``smallest`` takes the
    smaller pair of ids, ``first_seen`` the one that occurs first when documents
    are read in the order of column ``order``.
    """
    if vocab_size < 256:
        raise ValueError(f"vocab_size must be at least 256, not {vocab_size}")
    if vocab_size > S.MAX_TOKENS:
        raise ValueError(f"vocab_size must be at most {S.MAX_TOKENS}, not {vocab_size}")
    if tie == "smallest":
        return train_on_chunks(P.chunk_counts(docs, pattern, text), vocab_size - 256, batch)
    if tie != "first_seen":
        raise ValueError(f"tie must be 'smallest' or 'first_seen', not {tie!r}")
    if order is None:
        raise ValueError("tie='first_seen' needs the order of the documents")
    return _train_first_seen(docs, vocab_size - 256, pattern, text, order, batch)


def train_on_chunks(chunks: DataFrame, num_merges: int, batch: bool = True, rounds: list[Round] | None = None) -> list[TrainedMerge]:
    """Learn merges from chunk counts ``(chunk, cnt)``; ``rounds`` collects what each round did."""
    return _train(P.words(chunks).select("seq", "cnt"), num_merges, False, batch, rounds)


def _train_first_seen(
    docs: DataFrame, num_merges: int, pattern: str | None, text: str, order: str, batch: bool = True
) -> list[TrainedMerge]:
    """Ties go to the pair that occurs first; every chunk carries its first position."""
    exploded = P.explode_chunks(docs, pattern, text, order)
    first = F.min(F.struct(F.col(order), "pos")).alias("first")
    counts = exploded.groupBy("chunk").agg(F.count("*").alias("cnt"), first)
    return _train(P.words(counts).select("seq", "cnt", "first"), num_merges, True, batch)


@dataclass(frozen=True)
class Round:
    """What one round of training did: merges tried and made, index rows read, words changed."""

    tried: int
    made: int
    read: int
    changed: int


@dataclass(frozen=True)
class _Pick:
    """A pair to merge; ``bound`` is what is known of the pairs that its merge creates."""

    pair: str
    n: int
    bound: int = -1


def _train(words: DataFrame, num_merges: int, first_seen: bool, batch: bool, rounds: list[Round] | None = None) -> list[TrainedMerge]:
    merges: list[TrainedMerge] = []
    if num_merges <= 0:
        return merges
    generation, size, careful = _Generation(words, first_seen), 8, False
    while len(merges) < num_merges:
        if len(generation.pending) >= GENERATION_MERGES:
            generation = generation.following()
        size = min(size, num_merges - len(merges)) if batch else 1
        picks = generation.picks(size)[:size]
        picks = _independent_prefix(picks) if careful else _apart(picks)
        if not picks:
            if generation.pending:
                generation = generation.following()
                continue
            if generation.best is None:
                break
            # All pairs are equally frequent: the first one is known from the count of all.
            picks = [generation.best]
        changes, read, changed = generation.changes(picks, 256 + len(merges))
        made = 0
        for i, pick in enumerate(picks):
            if i and not generation.leads(pick.pair):
                break
            a, b = map(S.token_id, pick.pair)
            merge = TrainedMerge(len(merges), a, b, 256 + len(merges), generation.counts.get(pick.pair, pick.n))
            generation.apply(merge, changes[i])
            merges.append(merge)
            made += 1
        size = min(2 * size, ROUND_MERGES) if 2 * made > len(picks) else max(4, 2 * made)
        careful = 2 * made < len(picks)
        if rounds is not None:
            rounds.append(Round(len(picks), made, read, changed))
    return merges


class _Generation:
    """Words as they were written, the merges made since, and the counts of the leading pairs."""

    def __init__(self, words: DataFrame, first_seen: bool, indexed: bool = False):
        self.first_seen = first_seen
        self.keep = ["cnt", "first"] if first_seen else ["cnt"]
        self.words = materialize(words.where(F.length("seq") > 1), "words")
        self.n_words = self.words.count()
        # The first merges change much of the corpus: an index of it pays once rounds change little.
        self.index = materialize(self._index(), "index") if indexed else None
        self.rounds = self.changed = 0
        self.pending: list[tuple[str, str]] = []
        # What each token made since then consists of.
        self.parts: dict[str, str] = {}
        rows = self._leading().collect()
        self.floor = rows[FOLLOWED].n if len(rows) > FOLLOWED else 0
        self.best = _Pick(rows[0].pair, rows[0].n) if rows else None
        self.counts = {row.pair: row.n for row in rows[:FOLLOWED]}
        self.known = dict(self.counts)
        self.heap = [(-n, pair) for pair, n in self.counts.items()]
        heapify(self.heap)
        self.listed: dict[str, tuple[int, int]] = {}

    def _index(self) -> DataFrame:
        """One row per word and pair in it. Words of a frequent pair are spread over several ranges."""
        found = "array_distinct(transform(sequence(1, length(seq) - 1), i -> substring(seq, i, 2)))"
        rows = self.words.selectExpr(f"explode(if(length(seq) <= {INDEXED_LENGTH}, {found}, array(''))) AS pair", "seq", *self.keep)
        return rows.repartitionByRange(width(rows.sparkSession), "pair", F.xxhash64("seq")).sortWithinPartitions("pair")

    def _leading(self) -> DataFrame:
        counts = self._pairs_of(self.words)
        if self.first_seen:
            return counts.orderBy(F.desc("n"), "place").select("pair", "n").limit(FOLLOWED + 1)
        return P.best_pairs(counts, FOLLOWED + 1)

    def _pairs_of(self, rows: DataFrame, wanted: list[str] | None = None) -> DataFrame:
        """``(pair, n)`` and, if asked for, the first ``place`` of each pair in some words; of long words, only of wanted pairs."""
        short = P.explode_pairs(rows.where(F.length("seq") <= INDEXED_LENGTH), "seq", *self.keep).withColumnRenamed("cnt", "n")
        columns = ["pair", "n", *(["first", "off"] if self.first_seen else [])]
        short = short.select(*columns)
        # Cutting a long sequence at a place takes as long as reaching it: these are read in one go.
        long = rows.where(F.length("seq") > INDEXED_LENGTH).select("seq", *self.keep)
        both = short.unionByName(long.mapInArrow(_long_pairs_task(self.first_seen, wanted), short.schema))
        place = [F.min(F.struct("first", "off")).alias("place")] if self.first_seen else []
        return both.groupBy("pair").agg(F.sum("n").alias("n"), *place)

    def following(self) -> _Generation:
        """The next generation: the words with all merges since."""
        pays = self.index is not None or self.changed * INDEX_SHARE < self.n_words * self.rounds
        return _Generation(self.words.select(self._current().alias("seq"), *self.keep), self.first_seen, pays)

    def _current(self) -> Column:
        """Words with the merges made since the generation began."""
        pending = list(self.pending)

        def merged(seqs: pa.Array) -> pa.Array:
            out = []
            for seq in seqs.to_pylist():
                for pair, new in pending:
                    if pair in seq:
                        seq = seq.replace(pair, new)
                out.append(seq)
            return pa.array(out, pa.string())

        return F.arrow_udf(merged, "string")("seq")

    def picks(self, size: int) -> list[_Pick]:
        """The best pairs in order, as far as it is known; none if others may be as frequent."""
        found = nsmallest(size, ((-n, pair) for pair, n in self.counts.items() if n > self.floor))
        picks = [_Pick(pair, -n) for n, pair in found]
        if not self.first_seen or not picks:
            return picks
        # Ties are settled by first places: look at all pairs of a count, or at none.
        least = picks[-1].n
        ties = [pair for pair, n in self.counts.items() if n == least]
        picks = [pick for pick in picks if pick.n > least] + ([_Pick(pair, least) for pair in ties] if len(ties) <= LISTED_TIES else [])
        # Where no other pair is as frequent, the count says it all.
        alike = Counter(pick.n for pick in picks)
        tied = [pick for pick in picks if alike[pick.n] > 1]
        order = self._first_places([pick.pair for pick in tied]) if tied else {}
        self.listed = {pick.pair: (pick.n, order[pick.pair]) for pick in tied}
        return sorted(picks, key=lambda pick: (-pick.n, order.get(pick.pair, 0)))

    def _first_places(self, pairs: list[str]) -> dict[str, int]:
        """The order in which pairs occur first."""
        rows = self._rows_with(pairs).withColumn("seq", self._current())
        places = self._pairs_of(rows, pairs).where(F.col("pair").isin(pairs)).orderBy("place")
        return {row.pair: i for i, row in enumerate(places.select("pair").collect())}

    def leads(self, pair: str) -> bool:
        """Whether a pair is the best one by the counts as they are now."""
        while self.heap and self.counts.get(self.heap[0][1]) != -self.heap[0][0]:
            heappop(self.heap)
        if not self.heap or -self.heap[0][0] <= self.floor:
            return False
        n = -self.heap[0][0]
        if not self.first_seen or self.counts.get(pair) != n:
            return self.heap[0][1] == pair
        # A pair that has kept its count since its place was found has kept its place.
        ties = [other for other, count in self.counts.items() if count == n]
        known = [self.listed[other][1] for other in ties if self.listed.get(other, (0, 0))[0] == n]
        return ties == [pair] or len(known) == len(ties) and min(known) == self.listed[pair][1]

    def apply(self, merge: TrainedMerge, changes: list[tuple[str, int]]) -> None:
        a, b, new = map(S.symbol, (merge.a, merge.b, merge.new_id))
        self.pending.append((a + b, new))
        self.parts[new] = self.parts.get(a, a) + self.parts.get(b, b)
        for pair, change in changes:
            n = self.counts.get(pair, 0) + change
            if n > 0:
                self.counts[pair] = n
                heappush(self.heap, (-n, pair))
            else:
                self.counts.pop(pair, None)

    def _root(self, pair: str) -> str:
        """A pair of the generation's own tokens that every word with ``pair`` contains; of several the rarest."""
        spelt = "".join(self.parts.get(token, token) for token in pair)
        return min((spelt[i : i + 2] for i in range(len(spelt) - 1)), key=lambda p: (self.known.get(p, 0), p))

    def _rows_with(self, pairs: list[str]) -> DataFrame:
        """Words that may have any of the pairs, each under one or more of the generation's own pairs or under none.

        The condition has few forms, so that the plans of most rounds share their compiled code.
        """
        roots = sorted({self._root(pair) for pair in pairs})
        if self.index is None:
            some = "|".join("".join(f"\\x{{{ord(symbol):x}}}" for symbol in root) for root in roots)
            # Nearly every long word has one of the pairs: looking for them would cost more than reading it.
            likely = (F.length("seq") > INDEXED_LENGTH) | F.col("seq").rlike(some)
            return self.words.where(likely).withColumn("pair", F.lit(""))
        # Single comparisons reach the files' statistics in any number; a long list would only do so as a range.
        padding = [S.BREAK + str(i) for i in range((1 << len(roots).bit_length()) - len(roots) - 1)]
        found = [F.col("pair") == root for root in ["", *roots, *padding]]
        return self.index.where(reduce(lambda a, b: a | b, found) if len(found) <= 256 else F.col("pair").isin([*roots, ""]))

    def changes(self, picks: list[_Pick], next_id: int) -> tuple[list[list[tuple[str, int]]], int, int]:
        """For each merge the changes of the counts of pairs, if all before it were made; index rows read and words changed.

        The driver gets up to two rows per token and merge, and of the new pairs those that it will follow.
        """
        roots = sorted({self._root(pick.pair) for pick in picks})
        merges = [(pick.pair, S.symbol(next_id + i)) for i, pick in enumerate(picks)]
        task = _changes_task(list(self.pending), merges, roots)
        rows = self._rows_with([pick.pair for pick in picks]).select("pair", "seq", "cnt").mapInArrow(task, "step int, pair string, n long")
        sums = rows.groupBy("step", "pair").agg(F.sum("n").alias("n"))
        found: list[list[tuple[str, int]]] = [[] for _ in picks]
        read = changed = 0
        for row in sums.where((F.col("n") < 0) | (F.col("n") > self.floor) | (F.col("step") < 0)).collect():
            if row.step >= 0:
                found[row.step].append((row.pair, row.n))
            elif row.step == -1:
                read = row.n
            else:
                changed = row.n
        self.rounds, self.changed = self.rounds + 1, self.changed + changed
        return found, read, changed


def _changes_task(pending: list[tuple[str, str]], merges: list[tuple[str, str]], roots: list[str]):
    """Sums of the changes of pair counts per merge, for the words of one task."""
    before = {root: roots[:i] for i, root in enumerate(roots)} | {"": []}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: list[dict[str, int]] = [defaultdict(int) for _ in merges]
        read = changed = 0
        for batch in batches:
            read += batch.num_rows
            long: list[tuple[int, str]] = []
            for key, seq, cnt in zip(*(column.to_pylist() for column in batch.columns)):
                if len(seq) > INDEXED_LENGTH:
                    long.append((cnt, seq))
                    continue
                # A word that is listed under several of the pairs counts under the first one.
                if any(root in seq for root in before[key]):
                    continue
                for pair, new in pending:
                    if pair in seq:
                        seq = seq.replace(pair, new)
                found = False
                for (pair, new), total in zip(merges, sums):
                    if pair in seq:
                        found = True
                        add_changes(total, seq, pair, new, cnt)
                        seq = seq.replace(pair, new)
                changed += found
            long.sort(key=lambda word: word[0])
            for rows in _joinable([cnt for cnt, _ in long], [len(seq) for _, seq in long]):
                cnt, seq = long[rows.start][0], BREAK.join([long[i][1] for i in rows])
                for pair, new in pending:
                    seq = seq.replace(pair, new)
                symbols = _symbols(seq)
                for (pair, new), total in zip(merges, sums):
                    if pair in seq:
                        seq = seq.replace(pair, new)
                        before_it, symbols = symbols, _symbols(seq)
                        for changed_pair, n in _symbol_changes(before_it, symbols, new):
                            total[changed_pair] += n * cnt
                changed += sum(any(new in word for _, new in merges) for word in seq.split(BREAK))
        rows = [(step, pair, n) for step, total in enumerate(sums) for pair, n in total.items() if n] + [(-1, "", read), (-2, "", changed)]
        columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), (pa.int32(), pa.string(), pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["step", "pair", "n"])

    return task


def _joinable(counts: list[int], lengths: list[int]) -> Iterator[range]:
    """Neighbouring words of one count that are looked at as one string, each up to ``JOINED_LENGTH`` symbols."""
    begin = held = 0
    for i, (count, length) in enumerate(zip(counts, lengths)):
        if i > begin and (count != counts[begin] or held + length > JOINED_LENGTH):
            yield range(begin, i)
            begin, held = i, 0
        held += length
    if begin < len(counts):
        yield range(begin, len(counts))


def _long_pairs_task(first_seen: bool, wanted: list[str] | None = None):
    """Each pair of long words once per string of joined words, with its count and, if asked for, its first place."""
    chosen = None if wanted is None else np.array([ord(pair[0]) << 32 | ord(pair[1]) for pair in wanted], np.uint64)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seqs, cnts = batch.column("seq").to_pylist(), batch.column("cnt").to_pylist()
            # Words of one count in the order of their first places: the first place in the string is the first of all.
            place = [tuple((v is not None, v) for v in first.values()) for first in batch.column("first").to_pylist()] if first_seen else [()] * len(seqs)
            order = sorted(range(len(seqs)), key=lambda i: (cnts[i], place[i]))
            for rows in _joinable([cnts[i] for i in order], [len(seqs[i]) for i in order]):
                members = order[rows.start : rows.stop]
                codes, places, counts = _pair_codes(BREAK.join([seqs[i] for i in members]))
                if chosen is not None:
                    kept = np.isin(codes, chosen)
                    codes, places, counts = codes[kept], places[kept], counts[kept]
                columns = [pa.array(_spelt(codes), pa.string()), pa.array(counts * cnts[members[0]], pa.int64())]
                if first_seen:
                    starts = np.cumsum([0] + [len(seqs[i]) + 1 for i in members[:-1]])
                    word = np.searchsorted(starts, places, "right") - 1
                    columns += [batch.column("first").take(pa.array(np.array(members)[word], pa.int64())), pa.array(places - starts[word], pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, names=["pair", "n", *(["first", "off"] if first_seen else [])])

    return task


def _spelt(codes: np.ndarray) -> list[str]:
    return [chr(code >> 32) + chr(code & 0xFFFFFFFF) for code in codes.tolist()]


def _pair_codes(seq: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of the pairs of a string, their first places and their counts; pairs across a break are left out."""
    symbols = _symbols(seq)
    seen = np.zeros(ord(BREAK) + 1, bool)
    seen[symbols] = True
    seen[ord(BREAK)] = False
    present = np.flatnonzero(seen).astype(np.uint64)
    inside = np.flatnonzero((symbols[:-1] != ord(BREAK)) & (symbols[1:] != ord(BREAK)))
    if len(present) > DENSE_SYMBOLS:
        pairs = symbols[:-1].astype(np.uint64) << np.uint64(32) | symbols[1:]
        codes, places, counts = np.unique(pairs[inside], return_index=True, return_counts=True)
        return codes, inside[places], counts
    number = np.zeros(len(seen), np.int64)
    number[present] = np.arange(len(present))
    pairs = number[symbols[inside]] * len(present) + number[symbols[inside + 1]]
    counts = np.bincount(pairs, minlength=1)
    places = np.zeros(len(counts), np.int64)
    # Of several values for one place the last is kept.
    places[pairs[::-1]] = inside[::-1]
    found = np.flatnonzero(counts)
    codes = present[found // max(1, len(present))] << np.uint64(32) | present[found % max(1, len(present))] if len(found) else np.zeros(0, np.uint64)
    return codes, places[found], counts[found]


def add_changes(sums: dict[str, int], seq: str, pair: str, new: str, cnt: int) -> None:
    """Add how a merge changes the pairs of one sequence: those that touch a place of the merge.

    What stands between two places is one part; without it, the places touch.
    """
    first, second = pair
    parts = seq.split(pair)
    for i in range(1, len(parts)):
        sums[pair] -= cnt
        if left := parts[i - 1]:
            sums[left[-1] + first] -= cnt
            sums[left[-1] + new] += cnt
        elif i > 1:
            sums[second + first] -= cnt
            sums[new + new] += cnt
        if right := parts[i]:
            sums[second + right[0]] -= cnt
            sums[new + right[0]] += cnt


def long_changes(before: str, after: str, new: str) -> Iterator[tuple[str, int]]:
    """The same for long sequences joined by breaks: pairs and how often they come or go."""
    return _symbol_changes(_symbols(before), _symbols(after), new)


def _symbols(seq: str) -> np.ndarray:
    return np.frombuffer(seq.encode("utf-32-le"), "<u4")


def _symbol_changes(old: np.ndarray, now: np.ndarray, new: str) -> Iterator[tuple[str, int]]:
    places = np.flatnonzero(now == ord(new))
    # Each merge before a place has made the sequence one symbol shorter.
    merged = places + np.arange(len(places))
    for symbols, begins, n in ((old, merged[:, None] + [-1, 0, 1], -1), (now, places[:, None] + [-1, 0], 1)):
        begins = np.unique(begins)
        begins = begins[(begins >= 0) & (begins < len(symbols) - 1)]
        begins = begins[(symbols[begins] != ord(BREAK)) & (symbols[begins + 1] != ord(BREAK))]
        codes, counts = np.unique(symbols[begins].astype(np.uint64) << np.uint64(32) | symbols[begins + 1], return_counts=True)
        for code, count in zip(codes.tolist(), counts.tolist()):
            yield chr(code >> 32) + chr(code & 0xFFFFFFFF), n * count


def _apart(best: list) -> list:
    """Pairs in order without those that touch an earlier one: these lose occurrences to it and mostly fall behind."""
    take, firsts, seconds = [], set(), set()
    for row in best:
        first, second = row.pair
        if not take or first not in seconds and second not in firsts:
            take.append(row)
            firsts.add(first)
            seconds.add(second)
    return take


def _independent_prefix(best: list) -> list:
    """Leading pairs that stay the next best ones whatever the earlier of them create.

    None ends with the token that another begins with, so no occurrence of one
    touches an occurrence of another and each keeps its count; and each is more
    frequent than any pair that an earlier one is known to create.
    """
    take, firsts, seconds, bound = [], set(), set(), -1
    for row in best:
        first, second = row.pair
        if take and (row.n <= bound or first in seconds or second in firsts):
            break
        take.append(row)
        firsts.add(first)
        seconds.add(second)
        bound = max(bound, row.bound)
    return take


cloudpickle.register_pickle_by_value(sys.modules[__name__])
