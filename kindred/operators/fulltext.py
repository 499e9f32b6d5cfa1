"""Full-text match with BM25 ranking as joins and aggregations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred import config
from kindred.functions.binding import once
from kindred.functions.text import tokens
from kindred.operators.sizes import shipped
from kindred.session import materialize

# Fixed values of the published ranking formula.
K1 = 1.2
B = 0.75

# Sums arrive in any order; rounding makes equal documents score equal.
SCORE_DIGITS = 9

# Terms of all queries that are shipped to every task at most.
MAX_SHIPPED_TERMS = 200_000

# Postings that meet a query's term in one product; more documents wait for the next.
MEETINGS_AT_ONCE = 1_000_000

# Token of the row that carries a document's length; no text has it.
LENGTH_ROW = ""


def token_counts(token_array: Column) -> Column:
    """``array<struct<token, tf>>`` of a token list, computed inside the row:
    the list is sorted and the starts of its runs give the counts, so no rows
    are shuffled to count the tokens of one document."""

    def run_starts(ordered: Column) -> Column:
        places = F.transform(
            ordered, lambda t, i: F.when((i == 0) | (t != F.get(ordered, i - 1)), i)
        )
        return F.filter(places, lambda i: i.isNotNull())

    def counted(ordered: Column, starts: Column) -> Column:
        return F.transform(
            starts,
            lambda start, place: F.struct(
                F.get(ordered, start).alias("token"),
                (F.coalesce(F.get(starts, place + 1), F.size(ordered)) - start).cast("bigint").alias("tf"),
            ),
        )

    return once(
        F.array_sort(token_array),
        lambda ordered: once(run_starts(ordered), lambda starts: counted(ordered, starts)),
    )


def _split(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), tokens(F.col(text)).alias("tokens"))


def postings(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, token, tf, dl): how often a token stands in a document, and the
    document's length in tokens. One row per document and token, no shuffle;
    ``doc_id`` is the key of the table."""
    counted = _split(docs, doc_id, text).select(
        "doc_id", F.size("tokens").alias("dl"), F.explode(token_counts(F.col("tokens"))).alias("entry")
    )
    return counted.select("doc_id", "entry.token", "entry.tf", "dl")


def corpus_stats(docs: DataFrame, text: str) -> DataFrame:
    """One row: documents with at least one token, their mean length, all tokens."""
    length = docs.select(F.size(tokens(F.col(text))).alias("dl")).filter(F.col("dl") > 0)
    return length.agg(
        F.count(F.lit(1)).alias("n_docs"), F.avg("dl").alias("avg_dl"), F.coalesce(F.sum("dl"), F.lit(0)).alias("n_tokens")
    )


def token_stats(posting_table: DataFrame) -> DataFrame:
    """Documents and occurrences per token."""
    return posting_table.groupBy("token").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))


def match(
    docs: DataFrame,
    queries: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    query_id: str = "query_id",
    query: str = "query",
    size: int = config.MATCH_SIZE,
) -> DataFrame:
    """The ``size`` best documents of every query: ``query_id, rank, score, doc_id``.

    A document matches if it has any token of the query; a token that stands
    twice in the query counts twice. The texts are split once: postings of
    query tokens, and one length row per document, are written to the shared
    folder, and statistics and scores read that table. While the query
    vocabulary is small (it is counted) it is shipped to the scan, so only
    postings that matter leave it.
    """
    asked = materialize(
        queries.select(F.col(query_id).alias("query_id"), F.explode(tokens(F.col(query))).alias("token"))
        .groupBy("query_id", "token")
        .agg(F.count(F.lit(1)).alias("weight")),
        "asked",
    )
    n_terms = asked.count()
    wanted = asked.select("token").unionByName(asked.sparkSession.createDataFrame([(LENGTH_ROW,)], "token string"))
    wanted = wanted.distinct()
    entry = F.struct(F.lit(LENGTH_ROW).alias("token"), F.lit(0).cast("bigint").alias("tf"))
    split = _split(docs, doc_id, text).select(
        "doc_id",
        F.size("tokens").alias("dl"),
        F.explode(F.concat(F.array(entry), token_counts(F.col("tokens")))).alias("entry"),
    )
    rows = split.select("doc_id", "dl", "entry.token", "entry.tf")
    found = materialize(rows.join(shipped(wanted, n_terms), "token", "left_semi"), "found")
    lengths = found.filter((F.col("token") == LENGTH_ROW) & (F.col("dl") > 0))
    stats = lengths.agg(F.count(F.lit(1)).alias("n_docs"), F.avg("dl").alias("avg_dl")).first()
    n_docs, avg_dl = float(stats["n_docs"]), float(stats["avg_dl"] or 1.0)
    hits = found.filter(F.col("token") != LENGTH_ROW)
    frequency = hits.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log1p((F.lit(n_docs) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    terms = asked.join(frequency, "token").select("query_id", "token", (F.col("weight") * idf).alias("idf"))
    saturation = F.col("tf") / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / F.lit(avg_dl)))
    weighed = hits.select("doc_id", "token", saturation.alias("saturation"))
    if n_terms <= MAX_SHIPPED_TERMS:
        scored = _score_in_rows(weighed, terms, size)
    else:
        # too many terms to ship: one group per query and document
        scored = (
            weighed.join(terms, "token")
            .groupBy("query_id", "doc_id")
            .agg(F.round(F.sum(F.col("idf") * F.col("saturation")), SCORE_DIGITS).alias("score"))
        )
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("doc_id").asc())
    ranked = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)
    return ranked.select("query_id", "rank", "score", "doc_id")


def _score_in_rows(weighed: DataFrame, terms: DataFrame, size: int) -> DataFrame:
    """query_id, doc_id, score of every task's best ``size`` documents per query.

    A document's postings come together in one row, the counted terms of the
    queries are shipped, and each batch of documents is scored as a sparse
    product; no row per query and document leaves a task.
    """
    spark = weighed.sparkSession
    rows = terms.toPandas()
    rows = rows.iloc[np.argsort(rows["token"].to_numpy().astype(str), kind="stable")]
    query_ids, query = np.unique(rows["query_id"].to_numpy(), return_inverse=True)
    words, start = np.unique(rows["token"].to_numpy().astype(str), return_index=True)
    place = {word: i for i, word in enumerate(words.tolist())}
    shared = spark.sparkContext.broadcast((place, np.append(start, len(rows)), query, rows["idf"].to_numpy(), query_ids))
    documents = weighed.groupBy("doc_id").agg(F.collect_list("token").alias("words"), F.collect_list("saturation").alias("weights"))
    schema = T.StructType([terms.schema["query_id"], documents.schema["doc_id"], T.StructField("score", T.DoubleType())])

    def best(frame: pd.DataFrame) -> pd.DataFrame:
        ranked = frame.sort_values(["query", "score", "doc_id"], ascending=[True, False, True], kind="stable")
        return ranked[ranked.groupby("query").cumcount() < size]

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, bounds, of_query, idf, ids = shared.value
        held = None
        for batch in batches:
            n = batch["words"].map(len).to_numpy(np.int64)
            word = np.fromiter((place[w] for own in batch["words"] for w in own), np.int64, n.sum())
            weight = np.concatenate([np.zeros(0), *(np.asarray(w, float) for w in batch["weights"])])
            first = np.append(0, np.cumsum(n))
            # each posting meets the queries of its word
            meets = np.append(0, np.cumsum(bounds[word + 1] - bounds[word]))[first]
            for lo, hi in _runs(meets, MEETINGS_AT_ONCE):
                some = slice(first[lo], first[hi])
                found = _scored(batch["doc_id"].to_numpy()[lo:hi], n[lo:hi], word[some], weight[some], bounds, of_query, idf)
                held = best(found if held is None else pd.concat([held, found]))
        if held is not None and len(held):
            yield pd.DataFrame({"query_id": ids[held["query"].to_numpy()], "doc_id": held["doc_id"].to_numpy(), "score": held["score"].to_numpy()})

    return documents.mapInPandas(score, schema)


def _runs(before: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Documents one after the other whose meetings are ``most`` in all, or one document. ``before`` counts those before each."""
    lo = 0
    while lo < len(before) - 1:
        hi = max(lo + 1, int(np.searchsorted(before, before[lo] + most, "right")) - 1)
        yield lo, hi
        lo = hi


def _scored(
    doc_id: np.ndarray, n: np.ndarray, word: np.ndarray, weight: np.ndarray, bounds: np.ndarray, of_query: np.ndarray, idf: np.ndarray
) -> pd.DataFrame:
    """query (by number), doc_id and score of all of these documents, with ``n`` postings each, that match."""
    doc = np.repeat(np.arange(len(n)), n)
    times = bounds[word + 1] - bounds[word]
    at = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(bounds[word], times)
    pair = of_query[at] * len(n) + np.repeat(doc, times)
    pairs, back = np.unique(pair, return_inverse=True)
    total = np.bincount(back, idf[at] * np.repeat(weight, times), len(pairs))
    return pd.DataFrame({"query": pairs // len(n), "doc_id": doc_id[pairs % len(n)], "score": total.round(SCORE_DIGITS)})
