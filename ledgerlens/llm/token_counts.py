"""Token counts with a whole-token shortcut.

The model is a sentencepiece BPE whose normaliser is the identity and whose
pieces hold white space only in front, so no merge crosses the place where a
run of spaces begins: the count of a text is the sum over its pre-tokens (a run
of spaces and the word after it). ``Counter`` checks both properties on the
model file itself and raises if they do not hold.

Before the first text, every vocabulary string that is a whole pre-token is
encoded alone; those that come back as one token are the shortcut. Pre-tokens
found there count 1 directly; the rest are merged by the library, each distinct
one once as long as it stays in the bounded cache.

Edge cases: null and empty texts have no tokens; leading, trailing and repeated
spaces are pre-tokens of their own; U+2581 in a text is what the library takes
it for, a space; very long texts are counted whole.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_of

CACHE_ENTRIES = 400_000     # distinct merged pre-tokens a worker keeps
MARK = "▁"             # the library's escaped space
_PRETOKEN = re.compile(" +[^ ]*")


class Counter(dict):
    """Pre-token (without the first space) -> number of tokens."""

    def __init__(self, model_file: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        spec = proto.ModelProto()
        with open(model_file, "rb") as f:
            spec.ParseFromString(f.read())
        norm = spec.normalizer_spec
        pieces = [p.piece for p in spec.pieces if p.type == proto.ModelProto.SentencePiece.NORMAL]
        user = any(p.type == proto.ModelProto.SentencePiece.USER_DEFINED for p in spec.pieces)
        if (norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix or user
                or any(MARK in p.lstrip(MARK) for p in pieces) or MARK not in pieces):
            raise ValueError("pre-tokens of this model do not encode independently of each other")
        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        words = [p[1:] for p in pieces if p[0] == MARK and len(p) > 1]
        spoken = [w.replace(MARK, " ") for w in words]
        self.whole = {w: 1 for w, ids in zip(spoken, self.library.encode(spoken, num_threads=1)) if len(ids) == 1}
        self.whole[""] = 1    # a space alone is the piece MARK
        self.update(self.whole)

    def __missing__(self, key: str) -> int:
        if len(self) > CACHE_ENTRIES + len(self.whole):
            self.clear()
            self.update(self.whole)
        n = self[key] = len(self.library.encode(key))
        return n

    def count(self, text: str) -> int:
        if not text:
            return 0
        if MARK in text:
            text = text.replace(MARK, " ")
        if "  " in text or text[0] == " " or text[-1] == " ":
            keys = [x[1:] for x in _PRETOKEN.findall(" " + text)]
        else:
            keys = text.split(" ")
        return sum(map(self.__getitem__, keys))


@lru_cache(maxsize=2)
def counter(model_file: str) -> Counter:
    return Counter(model_file)


def token_count_udf(model_file: str):
    @F.pandas_udf(T.LongType())
    def count(texts: pd.Series) -> pd.Series:
        c = counter(model_file)
        return pd.Series([c.count(t) for t in texts], dtype="int64")
    return count


def token_counts(docs: DataFrame, model_file: str, limit: int = 4096,
                 id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row; no shuffle."""
    return docs.select(
        F.col(id_column).alias("doc_id"),
        F.octet_length(text_of(text_column)).cast("long").alias("n_bytes"),
        token_count_udf(model_file)(text_of(text_column)).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)
