"""Token counts with a digest cache, and the encoder that packing shares.

A count is stored under (digest of the content, digest of the tokenizer
file).  A run joins the digests of its documents to the cache, encodes one
text of each digest that misses, and appends the new counts.  The only
normalisation of content is that a null text is an empty text: anything else
would change counts.

Texts are not shuffled: the rows to encode are named by a 64-bit row key, and
the documents are filtered by whichever list is shorter, the rows to encode or
the rows to skip.

Defined results: null and empty texts have 0 bytes and 0 tokens; repeated rows
and repeated or null ids each give a row; other columns are ignored; an empty
table gives no rows and appends nothing.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.shared import stage, stage_path

#: Above this many characters without white space the merge loop of the fast
#: encoder is quadratic, and the reference encoder is used.
LONG_WORD = 1000


class Encoder:
    """Ids as the ``tokenizers`` library gives them for a .json file.

    A byte-level BPE whose ids follow its merges is also a rank table, which
    ``tiktoken`` encodes several times faster with the same result.  Texts
    outside Latin-1 (where the libraries' Unicode tables might differ) or
    with very long words go to ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        self.path, self._slow = path, None
        spec = json.load(open(path, encoding="utf-8"))
        self._fast = _ranked(spec)
        self._special = {t["content"] for t in spec.get("added_tokens", ())}

    @property
    def slow(self):
        if self._slow is None:
            import os

            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_file(self.path)
            self._slow.no_truncation()
            self._slow.no_padding()
        return self._slow

    def _is_plain(self, text: str) -> bool:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return False
        return len(text) <= LONG_WORD or max(map(len, text.split()), default=0) <= LONG_WORD

    def encode(self, text: str) -> np.ndarray:
        if self._fast is not None and self._is_plain(text):
            try:
                return self._fast.encode_to_numpy(text, allowed_special="all")
            except (KeyboardInterrupt, SystemExit):
                raise
            except BaseException:  # the Rust regex gives up by a panic; the reference encoder doesn't
                pass
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)


def _byte_alphabet() -> dict[str, int]:
    """Character of byte-level BPE files -> byte: printable characters stand
    for themselves, the others are moved up from code point 256."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = [b for b in range(256) if b not in set(keep)]
    return {chr(b): b for b in keep} | {chr(256 + i): b for i, b in enumerate(moved)}


def _ranked(spec: dict):
    """A tiktoken encoding of the same function, or None."""
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (model.get("type") == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
             and not pre.get("add_prefix_space") and spec.get("normalizer") is None
             and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix",
                                                "end_of_word_suffix", "byte_fallback", "ignore_merges")))
    if not plain:
        return None
    import tiktoken

    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    ids = [model["vocab"].get(a + b) for a, b in merges]
    added = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
    plain_flags = all(not t[k] for t in spec.get("added_tokens", ()) for k in ("lstrip", "rstrip", "single_word"))
    if None in ids or ids != sorted(ids) or not plain_flags:
        return None
    alphabet = _byte_alphabet()
    ranks = {bytes(alphabet[c] for c in token): i for token, i in model["vocab"].items() if token not in added}
    pattern = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")  # fixed: ByteLevel's own
    return tiktoken.Encoding("ranked", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added)


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def tokenizer_version(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


CACHE_SCHEMA = "content binary, tokenizer string, n_tokens long"


def count_tokens(docs: DataFrame, tokenizer_path: str, cache_path: str | None = None,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` per row.  ``cache_path`` names the
    cache table (shared storage); without it the run has a cache of its own."""
    spark = docs.sparkSession
    cache_path = cache_path or stage_path(spark, "token-cache")
    version = tokenizer_version(tokenizer_path)
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumn(
        "k", F.xxhash64("doc_id", "text"))
    rows = stage(keyed.select("doc_id", "k", F.unhex(F.sha2("text", 256)).alias("content"),
                              F.octet_length("text").cast("long").alias("n_bytes")), "token-digests")
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(cache_path)  # so that it exists

    def cached() -> DataFrame:
        return (spark.read.schema(CACHE_SCHEMA).parquet(cache_path).filter(F.col("tokenizer") == version)
                .groupBy("content").agg(F.max("n_tokens").alias("n_tokens")))

    # one row of each digest that misses
    misses = rows.join(cached().select("content"), "content", "left_anti")
    todo = stage(misses.groupBy(F.concat(F.lit(b""), "content").alias("c")).agg(F.min("k").alias("k"))
                 .select("k").distinct(), "token-todo")
    skip = stage(rows.select("k").distinct().join(todo, "k", "left_anti"), "token-skip")
    if skip.count() < todo.count():
        chosen = keyed.join(skip, "k", "left_anti")
    else:
        chosen = keyed.join(todo, "k", "left_semi")

    def encode(batches: Iterator) -> Iterator:
        import pyarrow as pa

        enc = encoder(tokenizer_path)
        for batch in batches:
            counts: dict[bytes, int] = {}
            for content, text in zip(batch.column("content").to_pylist(), batch.column("text"), strict=True):
                if content not in counts:  # rows that are repeated with their id share a row key
                    counts[content] = len(enc.encode(text.as_py()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.binary()), pa.array([version] * len(counts), pa.string()),
                 pa.array(list(counts.values()), pa.int64())], ["content", "tokenizer", "n_tokens"])

    new = chosen.select(F.unhex(F.sha2("text", 256)).alias("content"), "text").mapInArrow(encode, CACHE_SCHEMA)
    new = new.groupBy("content", "tokenizer").agg(F.max("n_tokens").alias("n_tokens"))
    new.write.mode("append").parquet(cache_path)
    return rows.join(cached(), "content").select("doc_id", "n_bytes", "n_tokens")
