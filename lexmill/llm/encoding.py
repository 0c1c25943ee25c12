"""Encoding of a corpus with a public byte-level tokenizer.

The frequent words of the corpus are counted over all documents, encoded once
and compiled into a minimal acyclic transducer, which every executor maps into
memory. Words it lacks are merged exactly from the public ranks.
"""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.llm.bounded import at_most, log_level
from lexmill.llm.bpe import load_ranks, merge, split_words
from lexmill.llm.transducer import Transducer, compile_transducer, pack
from lexmill.session import share_file

#: Words in the lexicon; those beyond it are merged, with the same result.
LEXICON_WORDS = 40_000
#: Entries after which a worker's table of merged words, or of counts, is emptied.
MEMO_WORDS = 200_000


def default_ranks() -> str:
    """The rank file of byte_bpe_50k as installed."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def word_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """``word`` (bytes), ``n``: how often each piece occurs in all texts; counted per task before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            words = [w.encode("utf-8", "surrogatepass") for w in seen]
            return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

        seen: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    seen.update(split_words(text))
            if len(seen) > MEMO_WORDS:
                yield out()
                seen.clear()
        if seen:
            yield out()

    parts = docs.select(F.col(text_col).cast("string").alias("t")).mapInArrow(count, "word binary, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(docs: DataFrame | None, text_col: str, ranks_path: str, size: int = LEXICON_WORDS) -> str:
    """Compiles the lexicon and hands it to the executors; the name of its file.

    ``docs`` None takes the vocabulary's own words instead of those of a corpus.
    At most ``size`` words come to the driver.
    """
    ranks = load_ranks(ranks_path)
    if docs is None:
        words = [w for w, r in ranks.items() if len(w) > 1][:size]
    else:
        top = at_most(word_counts(docs, text_col), log_level("n"), size)
        words = [bytes(r.word) for r in top.select("word").collect()]
    data = pack(compile_transducer([(w, merge(w, ranks)) for w in words]))
    return share_file(SparkSession.getActiveSession(), f"lexicon-{hashlib.sha1(data).hexdigest()[:16]}.bin", data)


class Encoder:
    """Encodes batches of texts: lexicon first, merges for the rest."""

    def __init__(self, lexicon: str, ranks_path: str):
        self.lexicon, self.ranks = Transducer(lexicon), load_ranks(ranks_path)
        self.merged: dict[bytes, np.ndarray] = {}

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of distinct words in one array, and where each word begins."""
        raw = [w.encode("utf-8", "replace") for w in words]
        ranks = self.lexicon.ranks(raw)
        parts = []
        for w, r in zip(raw, ranks.tolist()):
            if r >= 0:
                parts.append(self.lexicon.outputs(r))
                continue
            ids = self.merged.get(w)
            if ids is None:
                if len(self.merged) > MEMO_WORDS:
                    self.merged.clear()
                ids = self.merged[w] = np.array(merge(w, self.ranks), np.int32)
            parts.append(ids)
        first = np.zeros(len(parts) + 1, np.int64)
        np.cumsum([len(p) for p in parts], out=first[1:])
        return (np.concatenate(parts) if parts else np.zeros(0, np.int32)).astype(np.int32), first

    def batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in one array, where each text's ids begin)."""
        known: defaultdict[str, int] = defaultdict()
        known.default_factory = known.__len__  # a new word gets the next number
        at: list[int] = []
        ends = np.zeros(len(texts) + 1, np.int64)
        for i, text in enumerate(texts):
            if text:
                at += map(known.__getitem__, split_words(text))
            ends[i + 1] = len(at)
        pool, first = self.words(list(known))
        index = np.array(at, np.int64)
        lengths = np.diff(first)[index]
        total = np.concatenate([[0], np.cumsum(lengths)])
        take = np.arange(total[-1]) - np.repeat(total[:-1], lengths) + np.repeat(first[:-1][index], lengths)
        return pool[take], total[ends]


def encode_corpus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks_path: str | None = None, lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """``id_col`` and ``ids`` (array of int) of every row of ``docs``.

    Null and empty texts give the empty list, a null id stays null, repeated
    rows give a row each, other columns of ``docs`` are dropped whatever their
    names are, an empty table gives an empty result. Texts of any length are
    encoded whole. Special tokens' strings are ordinary text.
    """
    ranks_path = ranks_path or default_ranks()
    lexicon = build_lexicon(docs, text_col, ranks_path, lexicon_words)
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            encoder = encoder or Encoder(SparkFiles.get(lexicon), ranks_path)
            step = 500  # bounds the memory for long texts
            for k in range(0, batch.num_rows, step):
                part = batch.slice(k, step)
                ids, first = encoder.batch(part.column(1).to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], [id_col, "ids"])

    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text_")).mapInArrow(encode, schema)


def token_counts(docs: DataFrame, text_col: str, out_col: str = "n_tokens", ranks_path: str | None = None) -> DataFrame:
    """``docs`` with the number of tokens in place of ``text_col``; 0 for null and empty texts. A column ``out_col`` is replaced."""
    ranks_path = ranks_path or default_ranks()
    lexicon = build_lexicon(None, text_col, ranks_path, 1 << 17)
    keep = [c for c in docs.columns if c not in (text_col, out_col)]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(out_col, T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, sizes = None, {}
        for batch in batches:
            encoder = encoder or Encoder(SparkFiles.get(lexicon), ranks_path)
            n = []
            for text in batch.column(len(keep)).to_pylist():
                words = split_words(text) if text else []
                new = [w for w in dict.fromkeys(words) if w not in sizes]
                if new:
                    if len(sizes) > MEMO_WORDS:
                        sizes.clear()
                        new = list(dict.fromkeys(words))
                    sizes.update(zip(new, np.diff(encoder.words(new)[1]).tolist()))
                n.append(sum(map(sizes.__getitem__, words)))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(n, pa.int64())], schema.names)

    return docs.select(*keep, F.col(text_col).cast("string").alias("_text_")).mapInArrow(count, schema)
