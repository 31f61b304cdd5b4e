"""File readers. Schemas are stated, malformed rows fail the read unless a mode is passed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import extract_ints, round_rating, strip_edge_punct, tokens, words



def stem() -> Column:
    """Name of the scanned file, or of its folder where Spark wrote the file set as ``<name>/part-...``."""
    name = F.col("_metadata.file_name")
    folder = F.substring_index(F.substring_index("_metadata.file_path", "/", -2), "/", 1)  # for each row, so no pattern over a whole path
    return F.when(name.startswith("part-"), folder).otherwise(name)


def _scan(spark: SparkSession):
    """Readers of folders whose names carry meaning: no partition columns are guessed from them."""
    return spark.read.option("recursiveFileLookup", True)


# ---- delimited tables -----------------------------------------------------------------------------


def _csv(spark: SparkSession, path: str, schema: str, sep: str, header: bool = False, mode: str = "FAILFAST", **options) -> DataFrame:
    """``mode='PERMISSIVE'`` keeps malformed rows, their text goes to ``_corrupt_record``."""
    if mode == "PERMISSIVE":
        schema += ", _corrupt_record string"
    return spark.read.schema(schema).options(sep=sep, header=header, mode=mode, **options).csv(path)


def read_plays(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """Blank-delimited user, item, plays."""
    return _csv(spark, path, "user_id long, item_id long, plays long", " ", mode=mode)


def read_dim(spark: SparkSession, path: str) -> DataFrame:
    """Tab-delimited id, name. Quotes are plain characters; further fields are ignored."""
    line = spark.read.text(path).select(F.split("value", "\t").alias("f"))
    return line.select(F.col("f")[0].cast("bigint").alias("item_id"), F.col("f")[1].alias("name"))


def read_alias(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """Tab-delimited alias id, canonical id."""
    return _csv(spark, path, "bad_id long, good_id long", "\t", mode=mode)


def read_series(spark: SparkSession, path: str, time_col: str, cols: list[str]) -> DataFrame:
    """Header CSV with an explicit time column."""
    return _csv(spark, path, ", ".join([f"`{time_col}` long", *[f"`{c}` double" for c in cols]]), ",", header=True, enforceSchema=False)


def read_features(spark: SparkSession, folder: str, n_features: int) -> DataFrame:
    """Feature tables ``<split>_<horizon>.csv``: header, row id, features, target ``Yi`` last.

    Returns (row_id, x, y, split, horizon); split and horizon come from the file name.
    """
    cols = ", ".join(f"x{i} double" for i in range(n_features))
    raw = _scan(spark).schema(f"row_id long, {cols}, Yi double").options(header=True, mode="FAILFAST").csv(folder)
    return raw.select(
        "row_id", F.array(*[f"x{i}" for i in range(n_features)]).alias("x"), F.col("Yi").alias("y"),
        F.regexp_extract(stem(), r"^([a-z0-9]+)_", 1).alias("split"), F.regexp_extract(stem(), r"_(\d+)", 1).cast("int").alias("horizon"),
    )


def split_bidders(flat: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bids and budgets of a flat bidder table whose budget stands on one row per advertiser."""
    return flat.select("adv_id", "keyword", "bid"), flat.groupBy("adv_id").agg(F.max("budget").alias("budget"))


def read_bidders(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Header CSV advertiser, keyword, bid, budget."""
    return split_bidders(_csv(spark, path, "adv_id long, keyword string, bid double, budget double", ",", header=True))


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """Header TSV user, movie, rating, with the line position for the last-line rule.

    Position inside the file set: file name, then byte-ordered row id of the scan.
    """
    raw = spark.read.schema("user string, movie string, rating double").options(sep="\t", header=True, mode="FAILFAST").csv(path)
    pos = F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i"))
    return raw.select("*", pos.alias("line_no"))


def read_test_ratings(spark: SparkSession, path: str) -> DataFrame:
    return read_ratings(spark, path).select("user", "movie", round_rating("rating").alias("rating"))


# ---- text lines -----------------------------------------------------------------------------------


def read_wordlist(spark: SparkSession, path: str) -> DataFrame:
    """All whitespace tokens of a file, as a set."""
    return spark.read.text(path).select(F.explode(words("value")).alias("word")).distinct()


def read_labeled_docs(spark: SparkSession, folder: str) -> DataFrame:
    """Files ``<split>-<class>*.txt``, a document per line: (doc_id, label, split, tokens).

    doc_id is unique, not consecutive.
    """
    return _scan(spark).text(folder).select(
        F.monotonically_increasing_id().alias("doc_id"), F.regexp_extract(stem(), r"^[a-z]+-([a-z]+)", 1).alias("label"),
        F.regexp_extract(stem(), r"^([a-z]+)-", 1).alias("split"), tokens("value", sep=None, min_len=3).alias("tokens"),
    )


def read_queries(spark: SparkSession, path: str) -> DataFrame:
    """``seq<TAB>keyword`` lines; the sequence number makes the order explicit."""
    line = F.split("value", "\t", 2)
    return spark.read.text(path).select(line[0].cast("bigint").alias("seq"), F.trim(line[1]).alias("keyword"))


def read_query_lines(spark: SparkSession, path: str) -> DataFrame:
    """Plain keyword lines of one log, numbered in file order."""
    return number_lines(spark, path, "seq").select("seq", F.trim("value").alias("keyword"))


def number_lines(spark: SparkSession, path: str, name: str, only: Column | None = None) -> DataFrame:
    """Lines with their 0-based number, over all files of ``path`` in name order; ``only`` leaves out lines before they are numbered."""
    from ..operators.ordering import rank_within

    raw = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_block_start").alias("_b"), F.monotonically_increasing_id().alias("_i")
    )
    raw = raw if only is None else raw.where(only)
    ranked = rank_within(raw, [], [F.asc("_f"), F.asc("_b"), F.asc("_i")], name)
    return ranked.select((F.col(name) - 1).alias(name), "value")


def read_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """Category folders of text files: (category, doc, tokens), one row per file.

    Each line is lower-cased and loses punctuation at its ends before it is split.
    """
    raw = _scan(spark).option("wholetext", True).text(folder)
    path = F.col("_metadata.file_path")
    return raw.select(
        F.regexp_extract(path, r"([^/]+)/[^/]+$", 1).alias("category"), F.col("_metadata.file_name").alias("doc"),
        corpus_tokens("value").alias("tokens"),
    )


def corpus_tokens(c: str) -> Column:
    lines = F.transform(F.split(c, r"\r?\n"), lambda x: strip_edge_punct(F.regexp_replace(F.lower(x), r"^\s+|\s+$", "")))
    return F.filter(F.flatten(F.transform(lines, lambda x: F.split(x, r"\s+"))), lambda w: w != "")


def read_image_tags(spark: SparkSession, path: str) -> DataFrame:
    """``name tag tag ...`` lines; names without tags are dropped."""
    f = words("value")
    return spark.read.text(path).select(f.alias("f")).where(F.size("f") > 1).select(
        F.col("f")[0].alias("name"), F.slice("f", 2, F.size("f") - 1).alias("tags")
    )


def read_patches(spark: SparkSession, folder: str, tags: DataFrame) -> DataFrame:
    """Binary patch files ``<name>.<ext>``, or part files in a folder ``name=<name>``, of tagged images: (name, content).

    Images without a file are missing.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    named = files.select(F.regexp_extract("path", r"([^/=]+)(?:/part-[^/]*|\.[^./]+)$", 1).alias("name"), "content")
    return named.join(tags.select("name").distinct(), "name", "left_semi")


def read_movie_dims(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """``movies``, ``movie_directors``, ``movie_actors``, ``movie_genres``: header, whitespace-split, first two tokens."""
    out = {}
    for kind, base in (("movie", "movies"), ("director", "movie_directors"), ("actor", "movie_actors"), ("genre", "movie_genres")):
        raw = spark.read.schema("value string").options(header=True, sep="\u0001", quote="").csv(f"{folder}/{base}.dat")
        f = words("value")
        out[kind] = raw.select(f[0].alias("movie"), f[1].alias("name"))
    return out


# ---- graphs ---------------------------------------------------------------------------------------


def read_edges(spark: SparkSession, path: str, as_undirected: bool = True) -> DataFrame:
    """``x y`` lines."""
    from ..operators.graph import consistent, undirected

    f = words("value")
    e = spark.read.text(path).select(f[0].cast("bigint").alias("src"), f[1].cast("bigint").alias("dst"))
    return undirected(e) if as_undirected else consistent(e)


def read_adjacency(spark: SparkSession, path: str, as_undirected: bool = False) -> DataFrame:
    """``id n1 n2 ...`` lines, ``#`` lines skipped; a vertex may take several lines."""
    from ..operators.graph import undirected

    f = words("value")
    e = spark.read.text(path).where(~F.col("value").startswith("#")).select(f.alias("f")).where(F.size("f") > 1).select(
        F.col("f")[0].alias("src"), F.explode(F.slice("f", 2, F.size("f") - 1)).alias("dst")
    )
    return undirected(e) if as_undirected else e


def read_vertex_attrs(spark: SparkSession, path: str, n_attrs: int) -> DataFrame:
    """Header CSV ``id, a0, a1, ...``: (id, attrs)."""
    cols = ", ".join(f"a{i} double" for i in range(n_attrs))
    raw = _csv(spark, path, f"id long, {cols}", ",", header=True)
    return raw.select("id", F.array(*[f"a{i}" for i in range(n_attrs)]).alias("attrs"))


def read_vertex_rows(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV without ids, in one or more files: the row number (0-based) is the vertex id. Each file has its header line."""
    lines = number_lines(spark, path, "id", F.col("value").rlike(r"^[\d.,eE+\-]+$"))
    return lines.select("id", F.split("value", ",").cast("array<double>").alias("attrs"))


def read_communities(spark: SparkSession, path: str) -> DataFrame:
    """Line i lists the vertices of community i; a line may name its community before a tab instead."""
    named = F.when(F.instr("value", "\t") > 0, F.substring_index("value", "\t", 1).cast("bigint"))
    return number_lines(spark, path, "_line").select(
        F.explode(F.split(F.substring_index("value", "\t", -1), r",\s*")).alias("id"), F.coalesce(named, "_line").alias("comm")
    ).select(F.col("id").cast("bigint").alias("id"), "comm")


def read_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Numbered edge-list files: (snap, src, dst), number from the file name."""
    raw = _scan(spark).text(folder)
    n = F.regexp_extract(stem(), r"([0-9]+)", 1).cast("bigint")
    pair = extract_ints("value")
    return raw.select(n.alias("snap"), pair[0].alias("src"), pair[1].alias("dst")).where("src IS NOT NULL")


def read_walks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.split("value", " ").alias("path"))
