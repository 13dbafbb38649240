"""The tokenizer as users hold it: learned merges, pattern, special tokens."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.patterns import BOS, CHAT_PATTERN, CHAT_SPECIALS, GPT4_PATTERN, GPT4_SPECIALS
from corpusloom.operators import codec, vocabulary
from corpusloom.plans.training import TrainedMerge, train_bpe


@dataclass(frozen=True)
class CorpusTokenizer:
    """Merges, split pattern and special tokens.

    Its size is that of the vocabulary, whatever the corpus: it is held by the
    driver and travels inside the plans that encode and decode.
    """

    merges: tuple[TrainedMerge, ...]
    pattern: str | None = GPT4_PATTERN
    specials: Mapping[str, int] = field(default_factory=dict)
    permutation: tuple[int, ...] | None = None

    @classmethod
    def train(
        cls,
        docs: DataFrame,
        vocab_size: int,
        pattern: str | None = CHAT_PATTERN,
        specials: Sequence[str] = CHAT_SPECIALS,
        text: str = "text",
        tie: str = "smallest",
        order: str | None = None,
    ) -> CorpusTokenizer:
        """Train on a corpus, reserving the last ids for special tokens."""
        if vocab_size - len(specials) < 256:
            raise ValueError(f"vocab_size too small: {vocab_size - len(specials)} without special tokens")
        merges = train_bpe(docs, vocab_size - len(specials), pattern, text, tie, order)
        return cls(tuple(merges), pattern, vocabulary.append_specials(specials, 256 + len(merges)))

    @classmethod
    def from_ranks(
        cls, ranks: DataFrame, pattern: str = GPT4_PATTERN, specials: Mapping[str, int] = GPT4_SPECIALS
    ) -> CorpusTokenizer:
        """From a table of ranks ``(id, bytes)``, whose single bytes may be in any order."""
        permutation = vocabulary.byte_permutation(ranks)
        rows = vocabulary.recover_merges(ranks).orderBy("new_id").collect()
        merges = [TrainedMerge(r["rank"], r["a"], r["b"], r["new_id"], 0) for r in rows]
        if [m.new_id for m in merges] != list(range(256, 256 + len(merges))):
            raise ValueError("ranks must be numbered without gaps")
        identity = permutation == list(range(256))
        return cls(tuple(merges), pattern, dict(specials), None if identity else tuple(permutation))

    def register_specials(self, specials: Mapping[str, int]) -> CorpusTokenizer:
        if len(set(specials.values())) != len(specials):
            raise ValueError("two special tokens share an id")
        return CorpusTokenizer(self.merges, self.pattern, dict(specials), self.permutation)

    @cached_property
    def rules(self) -> list[tuple[int, int, int]]:
        return [(m.a, m.b, m.new_id) for m in self.merges]

    # -- vocabulary ---------------------------------------------------------

    @property
    def vocab_size(self) -> int:
        """One more than the largest id."""
        return max([255 + len(self.merges), *self.specials.values()]) + 1

    @property
    def bos_id(self) -> int:
        return self.special_id(BOS)

    @property
    def special_names(self) -> set[str]:
        return set(self.specials)

    def special_id(self, name: str) -> int:
        if name not in self.specials:
            raise KeyError(f"no special token {name!r}")
        return self.specials[name]

    def vocabulary(self, spark: SparkSession) -> DataFrame:
        return vocabulary.vocabulary(spark, self.merges, self.specials, self.permutation)

    def mergeable_ranks(self, spark: SparkSession) -> DataFrame:
        return vocabulary.mergeable_ranks(spark, self.merges, self.permutation)

    @cached_property
    def _token_hex(self) -> list[str]:
        known = [f"{b:02x}" for b in range(256)]
        for m in self.merges:
            known.append(known[m.a] + known[m.b])
        return known

    # -- columns ------------------------------------------------------------

    def _id(self, token: int | str | None) -> int | None:
        return self.special_id(token) if isinstance(token, str) else token

    def encode(
        self,
        text: Column | str,
        prepend: int | str | None = None,
        append: int | str | None = None,
        allowed_special: str | Collection[str] = "none",
        fold_limit: int = 0,
    ) -> Column:
        """Token ids of a text column.

        ``prepend`` and ``append`` are ids or names of special tokens.
        """
        if not isinstance(text, (Column, str)):
            raise ValueError(f"text must be a column or its name, not {type(text).__name__}")
        column = F.col(text) if isinstance(text, str) else text
        ids = codec.encode_with_specials(
            column, self.rules, self.pattern, self.specials, allowed_special, self.permutation, fold_limit
        )
        return codec.frame_ids(ids, self._id(prepend), self._id(append))

    def rows_encoder(self, text: str, prepend: int | str | None = None):
        """What :meth:`encode` gives, as a function of batches of rows for a pass that does more; None where the pattern does not allow it."""
        return codec.rows_encoder(self.rules, self.pattern, self.permutation, text, self._id(prepend))

    def decode(self, ids: Column | str) -> Column:
        column = F.col(ids) if isinstance(ids, str) else ids
        return codec.decode_ids(column, self._token_hex, self.specials, self.permutation)

    def id_to_token(self, token: Column | str) -> Column:
        column = F.col(token) if isinstance(token, str) else token
        return self.decode(F.array(column))

    def round_trip_failures(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """Rows whose text differs after encoding and decoding."""
        return docs.where(self.decode(self.encode(text)) != F.col(text))
