"""Encoding and decoding of whole columns."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Collection, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import sequences as S
from corpusloom.functions.cuts import encode_blocks
from corpusloom.functions.tasks import encode_texts, merge_chunk, symbol_ids
from corpusloom.functions.text import lossy_utf8
from corpusloom.operators.pretokenize import DIGITS, SPACE_BEGINS_CHUNK, allowed_specials, character_kinds, chunk_array, kind_pattern, refuse_specials, split_specials
from corpusloom.session import width

# Distinct chunks that a task remembers; beyond it the memory starts afresh.
CACHE_SIZE = 1 << 18


def _encode_chunks_udf(merges: Sequence[S.Merge]):
    """Arrow function ``array<string>`` of byte sequences -> ``array<int>``.

    Each distinct chunk of a batch is merged once; the result is spread over
    the batch by its dictionary indices.
    """
    rules = {S.symbol(a) + S.symbol(b): S.symbol(n) for a, b, n in merges}
    surrogates, gap = S.SURROGATES, S.GAP

    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known: dict[str, str] = {}
        for batch in batches:
            offsets = np.asarray(batch.offsets) - batch.offsets[0].as_py()
            chunks = batch.flatten().dictionary_encode()
            merged = []
            for seq in chunks.dictionary.to_pylist():
                if seq not in known:
                    if len(known) >= CACHE_SIZE:
                        known = {}
                    known[seq] = merge_chunk(seq, rules)
                merged.append(known[seq])
            index = np.asarray(chunks.indices)
            sizes = np.fromiter(map(len, merged), "int64", len(merged))
            ends = np.concatenate(([0], np.cumsum(sizes[index])))
            flat = symbol_ids("".join([merged[i] for i in index.tolist()]), surrogates, gap)
            mask = batch.is_null() if batch.null_count else None
            lists = pa.LargeListArray.from_arrays(ends[offsets], pa.array(flat, pa.int32()), mask=mask)
            yield lists.cast(pa.list_(pa.int32()))

    return F.arrow_udf(encode, "array<int>")


def _cut_in_tasks(merges: Sequence[S.Merge], pattern: str | None) -> bool:
    """Whether texts can go to the tasks as they are."""
    ranked = all(a < n and b < n for a, b, n in merges) and all(m[2] < n[2] for m, n in zip(merges, merges[1:]))
    return ranked and (pattern is None or pattern in SPACE_BEGINS_CHUNK)


def _text_encoder(merges: Sequence[S.Merge], pattern: str | None, permutation: Sequence[int] | None):
    """Function of batches of texts that gives their token ids, ``string`` -> ``array<int>``."""
    rules = {S.symbol(a) + S.symbol(b): S.symbol(n) for a, b, n in merges}
    cut, kinds = (None, b"") if pattern is None else (kind_pattern(pattern), character_kinds(SparkSession.active()))
    table = None if permutation is None else "".join(map(S.symbol, permutation))
    surrogates, gap, digits = S.SURROGATES, S.GAP, DIGITS.get(pattern)

    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if digits:
            return encode_blocks(batches, rules, kinds, digits, table, surrogates, gap)
        return encode_texts(batches, rules, cut, kinds, table, surrogates, gap)

    return encode


def rows_encoder(
    merges: Sequence[S.Merge], pattern: str | None, permutation: Sequence[int] | None, text: str, prepend: int | None = None
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]] | None:
    """Function of batches that puts ``ids`` and ``n_tokens`` in the place of a text column without nulls; None where texts are not cut in the tasks."""
    if not merges or not _cut_in_tasks(merges, pattern):
        return None
    encode = _text_encoder(merges, pattern, permutation)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: deque[pa.RecordBatch] = deque()

        def texts() -> Iterator[pa.Array]:
            for batch in batches:
                if batch.num_rows:
                    waiting.append(batch)
                    yield batch.column(text)

        # Ids come some rows at a time, in order.
        for lists in encode(texts()):
            while len(lists):
                batch = waiting.popleft()
                n = min(len(lists), batch.num_rows)
                if n < batch.num_rows:
                    waiting.appendleft(batch.slice(n))
                offsets = np.asarray(lists.slice(0, n).offsets).astype(np.int64)
                ids = lists.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
                offsets -= offsets[0]
                if prepend is not None:
                    ids = np.insert(ids, offsets[:-1], prepend)
                    offsets += np.arange(n + 1)
                columns = {name: column for name, column in zip(batch.schema.names, batch.slice(0, n).columns) if name != text}
                columns |= {"ids": pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids, pa.int32())), "n_tokens": pa.array(np.diff(offsets))}
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
                lists = lists.slice(n)

    return encoded


def _byte_seq(chunk: Column, permutation: Sequence[int] | None) -> Column:
    seq = S.byte_symbols(chunk)
    if permutation is None:
        return seq
    table = [S.symbol(p) for p in permutation]
    return F.array_join(F.transform(S.symbols(seq), lambda c: S.lookup(table, S.char_id(c), S.BREAK)), "")


def encode_sequences(
    seqs: Column, merges: Sequence[S.Merge], fold_limit: int = 0, num_tokens: int | None = None
) -> Column:
    """Token ids of an array of byte sequences, one per chunk, in order.

    No shuffle: merges are applied to the distinct chunks of each batch. A
    caller may have up to ``fold_limit`` merges folded over the joined
    sequences inside the JVM instead, one pass over the text for each.
    """
    if len(merges) <= fold_limit:
        return S.ids(S.fold(F.array_join(seqs, S.BREAK), merges), num_tokens or 256 + len(merges))
    return _encode_chunks_udf(merges)(seqs)


def encode_text(
    text: Column,
    merges: Sequence[S.Merge],
    pattern: str | None,
    permutation: Sequence[int] | None = None,
    fold_limit: int = 0,
) -> Column:
    """Token ids of a text; special tokens are read as plain text.

    Where the pattern allows it, texts go to the task as they are, which merges their distinct pieces between spaces once.
    """
    if len(merges) > fold_limit and _cut_in_tasks(merges, pattern):
        return F.arrow_udf(_text_encoder(merges, pattern, permutation), "array<int>")(text)
    seqs = F.transform(chunk_array(text, pattern), lambda c: _byte_seq(c, permutation))
    return encode_sequences(seqs, merges, fold_limit)


def encode_with_specials(
    text: Column,
    merges: Sequence[S.Merge],
    pattern: str | None,
    registered: Mapping[str, int],
    policy: str | Collection[str] = "none_raise",
    permutation: Sequence[int] | None = None,
    fold_limit: int = 0,
) -> Column:
    """Token ids of a text, recognising the special tokens that ``policy`` allows."""
    allowed = allowed_specials(registered, policy)
    if policy == "none_raise":
        text = refuse_specials(text, registered)
    if not allowed:
        return encode_text(text, merges, pattern, permutation, fold_limit)
    part_seqs = lambda p: F.transform(chunk_array(p, pattern), lambda c: _byte_seq(c, permutation))

    def part(p: Column) -> Column:
        out = part_seqs(p)
        for name, i in allowed.items():
            out = F.when(p == name, F.array(F.lit(S.symbol(i)))).otherwise(out)
        return out

    seqs = F.flatten(F.transform(split_specials(text, list(allowed)), part))
    top = max([256 + len(merges), *(i + 1 for i in allowed.values())])
    return encode_sequences(seqs, merges, fold_limit, top)


def frame_ids(token_ids: Column, prepend: int | None = None, append: int | None = None) -> Column:
    """Put fixed ids before and after every sequence."""
    parts = [token_ids]
    if prepend is not None:
        parts.insert(0, F.array(F.lit(prepend)))
    if append is not None:
        parts.append(F.array(F.lit(append)))
    return F.concat(*parts) if len(parts) > 1 else token_ids


def encode_chunk_table(
    chunks: DataFrame,
    merges: Sequence[S.Merge],
    chunk: str = "chunk",
    out: str = "ids",
    fold_limit: int = 0,
) -> DataFrame:
    """Encode a table of distinct chunks, once each.

    Few bytes, much work: adaptive execution would leave it to too few tasks.
    """
    return chunks.repartition(width(chunks.sparkSession), chunk).withColumn(out, encode_sequences(F.array(S.byte_symbols(F.col(chunk))), merges, fold_limit))


def token_counts(encoded_chunks: DataFrame, ids: str = "ids", weight: str = "cnt") -> DataFrame:
    """Token frequencies ``(id, n)`` from encoded distinct chunks and their counts."""
    return (
        encoded_chunks.select(weight, F.explode(ids).alias("id")).groupBy("id").agg(F.sum(weight).alias("n"))
    )


def decode_ids(
    token_ids: Column,
    token_hex: Sequence[str],
    specials: Mapping[str, int],
    permutation: Sequence[int] | None = None,
) -> Column:
    """Text of a token sequence; an unknown id fails the job.

    ``token_hex`` are the bytes of the plain tokens by id. With a byte
    permutation, these are permuted bytes and are mapped back; special tokens
    never are.
    """
    special_hex = {i: name.encode().hex() for name, i in specials.items()}
    if permutation is not None:
        back = {p: b for b, p in enumerate(permutation)}
        token_hex = [bytes(back[x] for x in bytes.fromhex(h)).hex() for h in token_hex]

    def known(i: Column) -> Column:
        value = S.lookup(token_hex, i)
        for sid, text in special_hex.items():
            value = F.when(i == sid, F.lit(text)).otherwise(value)
        return F.coalesce(value, F.raise_error(F.concat(F.lit("invalid token id: "), i.cast("string"))).cast("string"))

    return lossy_utf8(F.unhex(F.array_join(F.transform(token_ids, known), "")))


def unknown_ids(encoded: DataFrame, vocab: DataFrame, ids: str = "ids") -> DataFrame:
    """Token ids used in ``encoded`` that the vocabulary lacks, with their frequency."""
    used = encoded.select(F.explode(ids).alias("id")).groupBy("id").agg(F.count("*").alias("n"))
    return used.join(vocab.select("id"), "id", "left_anti")
