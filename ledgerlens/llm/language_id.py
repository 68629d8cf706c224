"""Language ID: sparse multinomial logistic regression on TF-IDF character
n-grams, trained by follow-the-regularised-leader with an elastic net, then
calibrated by a temperature.

Document frequencies are counted over every labelled training row. The
classifier is fitted on a bounded sample of them (``TRAIN_ROWS`` documents,
shared out equally among the languages and chosen by a hash of the id, whole
texts), a fifth of which is set aside for the temperature. Every row is then
scored in one pass without a shuffle. Languages, source and id are inputs of
no prediction.

Edge cases: a null text or one without letters is ``und`` with score 0; a null
``lang`` never trains; a null ``doc_id`` hashes as the empty string; without any
training row every text is ``und`` with score 0; very long texts count whole;
ties of scores go to the first language by code point. Every label with a
training row is learned, however rare (the model has ``2 ** BITS`` weights a
label).
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, text_of
from .linear import Ftrl, letters, ngrams, softmax

SIZES = (1, 2, 3)
BITS = 15
TRAIN_ROWS = 6_000
EPOCHS = 2


def crc(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def _counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    counts = np.bincount(ngrams(letters(text), SIZES, BITS), minlength=1 << BITS)
    idx = np.flatnonzero(counts)
    return idx, counts[idx]


def _features(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    idx, n = _counts(text)
    x = (1.0 + np.log(n)) * idf[idx]
    norm = np.sqrt(x @ x)
    return idx, x / norm if norm else x


def document_frequencies(train: DataFrame) -> DataFrame:
    """``place, n`` over all rows: summed per task, then per place."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, rows = np.zeros(1 << BITS, np.int64), 0
        for batch in batches:
            for text in batch["_text"]:
                total[_counts(text)[0]] += 1
                rows += 1
        idx = np.flatnonzero(total)
        yield pd.DataFrame({"place": np.append(idx, -1), "n": np.append(total[idx], rows)})
    return (train.select("_text").mapInPandas(count, "place long, n long")
            .groupBy("place").agg(F.sum("n").alias("n")))


def _sample(train: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` rows, as many of each language, by a hash of the id."""
    langs = stored(train.groupBy("_lang").agg(F.count(F.lit(1)).alias("n"), F.min("_u").alias("_low")), "op6-langs")
    each = rows / max(1, langs.count())
    share = langs.select("_lang", F.least(F.lit(1.0), each / F.col("n")).alias("_share"), "_low")
    # a row a language; the first by hash always stays
    return train.join(F.broadcast(share), "_lang").filter("_u < _share OR _u = _low").drop("_share", "_low")


def _fit(idf: np.ndarray, epochs: int):
    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["_mix", "_lang"], kind="stable")
        langs = sorted(set(rows["_lang"]), key=lambda s: s.encode())
        code = {v: i for i, v in enumerate(langs)}
        data = [(*_features(t, idf), code[v]) for t, v in zip(rows["_text"], rows["_lang"])]
        data = [d for d in data if len(d[0])]
        aside, own = data[::5], [d for i, d in enumerate(data) if i % 5] or data
        learned = {y for *_, y in own}
        own += [d for d in aside if d[2] not in learned]     # a language with too few rows to set one aside
        model = Ftrl(len(langs), 1 << BITS, alpha=1.0, l1=0.02, l2=0.01)
        for _ in range(epochs):
            for idx, x, y in own:
                model.update(idx, x, y)
        w = model.weights()
        scores = np.array([x @ w[idx] for idx, x, _ in aside]).reshape(len(aside), len(langs))
        truth = np.array([y for *_, y in aside], int)

        def loss(t: float) -> float:
            p = softmax(scores / t)[np.arange(len(truth)), truth]
            return float(-np.log(np.maximum(p, 1e-12)).mean()) if len(truth) else t
        temperature = min(np.geomspace(0.05, 20, 120), key=loss)
        blob = pickle.dumps((langs, w.astype(np.float32), float(temperature)))
        return pd.DataFrame({"model": [blob]})
    return fit


def train_model(docs: DataFrame, id_column="doc_id", text_column="text", lang_column="lang",
                train_rows: int = TRAIN_ROWS, epochs: int = EPOCHS):
    """``(languages, weights, temperature, idf)`` from the rows that are not
    held out; None without such rows."""
    train = docs.filter((crc(F.col(id_column)) % 4 != 2) & F.col(lang_column).isNotNull()).select(
        text_of(text_column).alias("_text"), F.col(lang_column).cast("string").alias("_lang"),
        F.xxhash64(F.coalesce(F.col(id_column).cast("string"), F.lit(""))).alias("_mix"))
    train = train.withColumn("_u", F.shiftrightunsigned("_mix", 11) / F.lit(float(1 << 53)))
    df = document_frequencies(train).collect()          # at most 2 ** BITS + 1 rows
    n = dict((r["place"], r["n"]) for r in df)
    rows = n.pop(-1, 0)
    if not rows:
        return None
    idf = np.full(1 << BITS, np.log((1 + rows) / 1) + 1)
    places = np.fromiter(n, int, len(n))
    idf[places] = np.log((1 + rows) / (1 + np.fromiter(n.values(), float, len(n)))) + 1
    fitted = _sample(train, train_rows).groupBy(F.lit(0).alias("one")).applyInPandas(
        _fit(idf, epochs), "model binary").first()       # the bounded sample
    return None if fitted is None else (*pickle.loads(bytes(fitted["model"])), idf)


def identify(docs: DataFrame, model, id_column="doc_id", text_column="text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)   # 2 ** BITS x languages

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            if shared.value is None or not any(map(str.isalpha, text)):
                out.append(("und", 0.0))
                continue
            langs, w, temperature, idf = shared.value
            idx, x = _features(text, idf)
            p = softmax((x @ w[idx].astype(float)) / temperature)
            best = int(p.argmax())
            out.append((langs[best], float(min(1.0, p[best]))))
        return pd.DataFrame(out, columns=["lang_pred", "score"])

    return docs.select(
        F.col(id_column).alias("doc_id"), (crc(F.col(id_column)) % 4 == 2).alias("held_out"),
        predict(text_of(text_column)).alias("p")).select("doc_id", "held_out", "p.*")


def language_id(docs: DataFrame, id_column="doc_id", text_column="text", lang_column="lang", **options) -> DataFrame:
    return identify(docs, train_model(docs, id_column, text_column, lang_column, **options), id_column, text_column)
