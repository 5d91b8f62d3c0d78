"""Text corpora in one schema."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quillwork.fixed import CORPORA, MAX_WORDS
from quillwork.functions.text import fewer_words, join_texts, word_count


def raw_texts(
    df: DataFrame, key_columns: str | list[str], source: Column, split: Column, corpus: Column, row_key=(),
    max_words: int | None = None, seen: Observation | None = None,
) -> DataFrame:
    """One corpus frame as raw_texts: the key column, or several joined by newlines.

    Rows whose text (or a part of it) is null are rejected here. ``row_key`` columns are carried along. With ``max_words`` only
    shorter texts are kept, and words are counted in those alone. ``seen`` observes the rows read, rejected
    and too long, and tells them once the result has been written; ``rejected_texts`` counts by a scan of its own.
    """
    columns = [key_columns] if isinstance(key_columns, str) else list(key_columns)
    text = join_texts(*columns)
    named = df.select(
        *row_key, text.alias("original_text"), source.alias("source"), split.alias("split"), corpus.alias("corpus")
    )
    if seen is not None:
        short = F.lit(True) if max_words is None else fewer_words("original_text", max_words)
        missing = F.col("original_text").isNull()
        named = named.observe(
            seen, F.count(F.lit(1)).alias("read"), F.count_if(missing).alias("rejected"), F.count_if(~missing & ~short).alias("too_long")
        )
    named = named.where(F.col("original_text").isNotNull())
    if max_words is not None:
        named = named.where(fewer_words("original_text", max_words))
    return named.withColumn("original_length", word_count("original_text")).select(
        *row_key, "original_text", "source", "split", "original_length", "corpus"
    )


def rejected_texts(df: DataFrame, key_columns: str | list[str]) -> DataFrame:
    """Number of rows that ``raw_texts`` rejects, as a one-row frame."""
    columns = [key_columns] if isinstance(key_columns, str) else list(key_columns)
    missing = F.when(join_texts(*columns).isNull(), 1)
    return df.agg(F.count(missing).alias("rejected"))


def read_text_corpus(
    spark: SparkSession,
    dataset_name: str,
    key_column: str | list[str],
    path: str | None = None,
    subset: str | None = None,
    splits: list[str] | None = None,
    data_files: Mapping[str, str | list[str]] | None = None,
    file_format: str = "parquet",
    corpus: str | None = None,
    max_words: int | None = None,
    seen: dict[tuple[str, str], Observation] | None = None,
    **options: str,
) -> DataFrame:
    """Read the kept splits of a corpus.

    Splits are the folders ``path[/subset]/<split>``, or the entries of
    ``data_files``. A split that is asked for and not there is an error. With ``seen`` each split's rows are
    observed, under (corpus, split).
    """
    splits = splits or ["train"]
    frames = []
    for split in splits:
        if data_files is not None:
            if split not in data_files:
                raise ValueError(f"{dataset_name} has no split {split!r}")
            where = data_files[split]
        elif path is not None:
            where = "/".join([path, *([subset] if subset else []), split])
        else:
            raise ValueError("give path or data_files")
        frame = spark.read.format(file_format).options(**options).load(where)
        watch = None if seen is None else seen.setdefault((corpus or dataset_name, split), Observation())
        frames.append(
            raw_texts(
                frame, key_column, F.lit(dataset_name), F.lit(split), F.lit(corpus or dataset_name), max_words=max_words, seen=watch
            )
        )
    union = frames[0]
    for frame in frames[1:]:
        union = union.unionByName(frame)
    return union


def read_known_corpora(
    spark: SparkSession, root: str, file_format: str = "parquet", max_words: int | None = MAX_WORDS,
    seen: dict[tuple[str, str], Observation] | None = None,
) -> list[DataFrame]:
    """The eight known corpora, short texts only, each read from ``root/<corpus>/<split>``."""
    return [
        read_text_corpus(
            spark, dataset_name, keys, path=f"{root}/{corpus}", splits=splits, file_format=file_format, corpus=corpus,
            max_words=max_words, seen=seen,
        )
        for corpus, dataset_name, keys, splits in CORPORA
    ]


def seen_counts(spark: SparkSession, seen: dict[tuple[str, str], Observation]) -> DataFrame:
    """(corpus, split, read, rejected, too_long), after the texts were written: one row a split, no scan."""
    rows = [(*name, *(watch.get[c] for c in ("read", "rejected", "too_long"))) for name, watch in seen.items()]
    return spark.createDataFrame(rows, "corpus string, split string, read long, rejected long, too_long long")


def short_texts(df: DataFrame, max_words: int = MAX_WORDS) -> DataFrame:
    return df.where(F.col("original_length") < max_words)
