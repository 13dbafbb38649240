"""Corpus tokenization on Spark DataFrames: chunking, BPE training, encoding and sequence packing."""

from corpusloom.plans.loader import pack_corpus
from corpusloom.plans.tokenizer import CorpusTokenizer
from corpusloom.plans.training import train_bpe

__all__ = ["CorpusTokenizer", "train_bpe", "pack_corpus"]
