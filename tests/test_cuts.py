"""Chunks of many texts at once against the patterns, and how much one task reads or shuffles."""

import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from corpusloom.functions import cuts, tasks
from corpusloom.functions import sequences as S
from corpusloom.functions.patterns import CHAT_PATTERN, GPT4_PATTERN
from corpusloom.operators import packing
from corpusloom.operators.pretokenize import DIGITS, character_kinds, kind_pattern
from corpusloom.sources.row_groups import RowGroupReader

ALPHABET = "aSsLlVvEeRrtx''' '  \n\r\t!-.0123éſ 　中\U0001f600½\x00\x85​\x1c"
RULES = [(ord("s"), ord("s"), 256), (ord(" "), ord("a"), 257), (256, ord("s"), 258), (0xC3, 0xA9, 259)]


def texts(seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(30))) for _ in range(2000)] + [None, "", "a" * 99, "'s" * 40, " ss" * 50]


@pytest.mark.parametrize("pattern", [GPT4_PATTERN, CHAT_PATTERN])
@pytest.mark.parametrize("block, passes", [(1 << 20, 64), (5, 64), (40, 0)])
def test_blocks_are_cut_like_single_texts(spark, monkeypatch, pattern, block, passes):
    monkeypatch.setattr(cuts, "BLOCK", block)
    monkeypatch.setattr(cuts, "PASSES", passes)
    kinds, given = character_kinds(spark), texts(block)
    rules = {S.symbol(a) + S.symbol(b): S.symbol(n) for a, b, n in RULES}
    expected = tasks.encode_texts(iter([pa.array(given)]), rules, kind_pattern(pattern), kinds, None, S.SURROGATES, S.GAP)
    found = cuts.encode_blocks(iter([pa.array(given)]), rules, kinds, DIGITS[pattern], None, S.SURROGATES, S.GAP)
    assert [ids for part in found for ids in part.to_pylist()] == next(expected).to_pylist()

    kinds_of, find = zlib.decompress(kinds).decode(), re.compile(kind_pattern(pattern)).finditer
    known = [text for text in given if text is not None]
    chunks = Counter(text[m.start() : m.end()] for text in known for m in find(text.translate(kinds_of)))
    counted = Counter()
    for part in cuts.count_blocks(iter([pa.record_batch({"text": known})]), kinds, DIGITS[pattern]):
        for row in part.to_pylist():
            counted[row["chunk"]] += row["n"]
    assert counted == chunks


def test_small_files_are_read_by_one_task(tmp_path):
    import json

    from pyarrow import parquet

    paths = [tmp_path / f"s{i}.parquet" for i in range(20)]
    for i, path in enumerate(paths):
        parquet.write_table(pa.table({"text": [f"{i} {row}" for row in range(6)]}), path, row_group_size=2)
    reader = RowGroupReader({"shards": json.dumps([(i, path.as_uri()) for i, path in enumerate(paths)])})
    (part,) = reader.partitions()
    read = [(row["shard_idx"], row["rg_idx"], row["text"]) for batch in reader.read(part) for row in batch.to_pylist()]
    assert read == [(i, row // 2, f"{i} {row}") for i in range(20) for row in range(6)]


def test_only_windows_at_edges_of_tasks_are_put_together(spark, monkeypatch):
    """The last window may be incomplete; the same as by putting all pieces together."""
    docs = spark.createDataFrame([(i, 0, i // 7, i % 7, list(range(i, i + i % 11))) for i in range(300)], "doc_id long, rank int, shard_idx int, rg_idx int, ids array<int>")
    monkeypatch.setattr(packing, "CUT_ROWS", 16)
    placed = packing.stream_positions(docs, "doc_id").cache()
    assert sorted(packing.run_windows(placed, 13).collect()) == sorted(packing.assemble(placed, 13).collect())
