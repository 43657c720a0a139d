"""Text-table operators: preprocessing, class index, label lookup, vocabulary
encoding and padding (FP1-FP3, AG1-AG3, JN1, JN2, AR5, AR6, AR13, UD4, UD5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.arrays import pad_mask, pad_to
from tessera.functions.text import STOPWORDS, clean_text, text_feature
from tessera.operators.core import bucketed_rank, checked_broadcast, fixed_batches
from tessera.session import materialize


def with_text(df: DataFrame, title: str = "title", description: str = "description") -> DataFrame:
    """FP1: ``text = title || ' ' || description``."""
    return df.withColumn("text", text_feature(F.col(title), F.col(description)))


def distinct_labels(df: DataFrame, label: str = "tag") -> DataFrame:
    """AG1: the class list."""
    return df.select(label).distinct()


def num_classes(df: DataFrame, label: str = "tag") -> DataFrame:
    """AG2: distinct label count (one row)."""
    return df.agg(F.count_distinct(F.col(label)).cast("bigint").alias("num_classes"))


def fit_class_index(df: DataFrame, label: str = "tag", index_col: str = "class_index") -> DataFrame:
    """AG3: class -> 0..k-1 in ascending label order (the fitted state).

    The global window runs on the distinct-label table only (k rows)."""
    classes = df.select(label).where(F.col(label).isNotNull()).distinct()
    w = Window.orderBy(F.col(label))
    return classes.withColumn(index_col, (F.row_number().over(w) - 1).cast("bigint"))


def encode_labels(df: DataFrame, classes: DataFrame, label: str = "tag", index_col: str = "class_index") -> DataFrame:
    """JN1: left lookup, unseen label -> NULL. The class table is broadcast if
    its size allows."""
    return df.join(checked_broadcast(classes), on=label, how="left")


def decode_labels(df: DataFrame, classes: DataFrame, index: str, label: str = "tag", index_col: str = "class_index", out: str = "predicted_tag") -> DataFrame:
    """JN2: index -> class name, the class table broadcast if its size allows."""
    lut = classes.select(F.col(index_col).alias(index), F.col(label).alias(out))
    return df.join(checked_broadcast(lut), on=index, how="left")


def preprocess(
    df: DataFrame,
    classes: DataFrame,
    *,
    stopwords=STOPWORDS,
    label: str = "tag",
    index_col: str = "class_index",
    keep: list[str] | None = None,
) -> DataFrame:
    """UD5 up to the tokenizer: text feature, clean, drop / select columns,
    encode the label. ``keep`` lists extra columns (e.g. a key) to carry."""
    keep = list(keep or [])
    t = with_text(df).withColumn("text", clean_text(F.col("text"), stopwords))
    t = t.drop("created_on", "title", "description")  # FP2
    t = t.select(*keep, "text", label)  # FP3
    return encode_labels(t, classes, label, index_col)


def preprocess_tokens(
    df: DataFrame, classes: DataFrame, vocab: DataFrame | None = None, *, key: str = "id", batch_size: int = 64, stopwords=STOPWORDS
) -> DataFrame:
    """UD5 in one call: ``(key, batch, ids, masks, targets)``, ids padded to the
    longest text of their batch, targets the class index (NULL if unseen).
    Without ``vocab`` the vocabulary is that of the texts themselves."""
    t = preprocess(df, classes, stopwords=stopwords, keep=[key])
    cleaned = materialize(t.select(key, "text", F.col("class_index").alias("targets")))  # read twice to be encoded
    vocab = build_vocabulary(cleaned) if vocab is None else vocab
    encoded = materialize(encode_tokens(cleaned, vocab, key).drop("text"))  # counted, ranked and padded
    padded = pad_batch(fixed_batches(encoded, key, batch_size), "batch", "ids")
    return padded.select(key, "batch", "ids", "masks", "targets")


def build_vocabulary(df: DataFrame, text: str = "text", *, min_count: int = 1, digits: int = 2) -> DataFrame:
    """AR13 vocabulary: whitespace tokens counted over the corpus, ids by count
    descending then token; 0 = pad, 1 = unknown, words from 2. The ranking is
    bucketed by (count, token prefix) so no single task ranks all words."""
    words = (
        df.select(F.explode(F.split(F.col(text), " ")).alias("token"))
        .where(F.col("token") != "")
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("count"))
        .where(F.col("count") >= min_count)
    )
    # Bucket (-count, first two characters of the token) is non-decreasing
    # along (count desc, token), and splits the huge count-1 tail by prefix.
    bucket = F.struct((-F.col("count")).alias("c"), F.substring("token", 1, 2).alias("p"))
    ranked = bucketed_rank(words, order=[F.col("count").desc(), F.col("token")], bucket=bucket, rank_col="rank")
    return ranked.select("token", (F.col("rank") + 1).cast("bigint").alias("token_id"), F.col("count").cast("bigint").alias("count"))


def encode_tokens(df: DataFrame, vocab: DataFrame, key: str, text: str = "text") -> DataFrame:
    """AR13 encode: ``ids array<bigint>`` in token order, unknown -> 1.

    Tokens are exploded with their position, joined to the vocabulary
    (shuffle join: the vocabulary grows with the corpus) and re-collected
    per key sorted by position."""
    toks = df.select(F.col(key), F.posexplode(F.split(F.col(text), " ")).alias("pos", "token")).where(
        F.col("token") != ""
    )
    joined = toks.join(vocab.select("token", "token_id"), on="token", how="left")
    ids = joined.groupBy(key).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("pos", F.coalesce("token_id", F.lit(1)).alias("id")))),
            lambda s: s["id"],
        ).alias("ids")
    )
    return df.join(ids, on=key, how="left").withColumn(
        "ids", F.coalesce(F.col("ids"), F.array().cast("array<bigint>"))
    )


def pad_batch(df: DataFrame, batch: str = "batch", ids: str = "ids") -> DataFrame:
    """AR5 + AR6 + AG22: pad each row to the longest row of its batch and add
    the mask. The batch maximum is taken over the rows of the batch, which the
    one shuffle brings together: the rows are not made a second time for it."""
    longest = F.max(F.size(ids)).over(Window.partitionBy(batch))
    return (
        df.where(F.col(batch).isNotNull())
        .withColumn("max_len", longest)
        .withColumn("masks", pad_mask(F.col(ids), F.col("max_len")))
        .withColumn(ids, pad_to(F.col(ids), F.col("max_len")))
    )
