"""The dataset catalog: a table of datasets with facets, and the questions the workflow asks of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.names import parse_path

FACETS = (
    "path", "id", "driving_institution", "driving_model", "institution", "source", "experiment", "domain", "frequency",
    "xrfreq", "processing_level", "type", "activity", "mip_era", "version", "bias_adjust_institution",
    "bias_adjust_project", "date_start", "date_end",
)
CATALOG_SCHEMA = T.StructType(
    [T.StructField(f, T.StringType(), True) for f in FACETS] + [T.StructField("variable", T.StringType(), True)]
)
MEMBER = ("driving_institution", "driving_model", "institution", "source")


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Read a catalog CSV with any subset of the facets; ``variable`` holds a ``;``-separated list."""
    df = spark.read.option("header", True).csv(path)
    return df.withColumn("variable", F.split("variable", ";"))


def write_catalog(df: DataFrame, path: str) -> None:
    df.withColumn("variable", F.array_join("variable", ";")).write.mode("errorifexists").option("header", True).csv(path)


def scan_paths(
    spark: SparkSession, root: str | Sequence[str], glob: str, patterns: Sequence[str], constants: dict[str, str]
) -> DataFrame:
    """Catalog rows of the dataset folders below ``root``: path, parsed fields, constants.

    Only file names are listed (the content column is pruned); a dataset is the folder holding the files that match
    ``glob``.  A name that fits no pattern is left out.
    """
    roots = [root] if isinstance(root, str) else list(root)
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
        .load(roots).select("path")
    )
    return catalog_rows(files.select(F.regexp_replace("path", "/[^/]*$", "").alias("path")).distinct(), patterns, constants)


def listing(spark: SparkSession, root: str | Sequence[str], glob: str) -> DataFrame:
    """The dataset folders below ``root`` as they are now: path, number of files, bytes, time of the latest file.

    Names, times and sizes only; large trees are listed in tasks.
    """
    roots = [root] if isinstance(root, str) else list(root)
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
        .load(roots).select("path", "modificationTime", "length")
    )
    return files.groupBy(F.regexp_replace("path", "/[^/]*$", "").alias("path")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.max("modificationTime").alias("modified"))


def listing_changes(former: DataFrame, now: DataFrame) -> DataFrame:
    """(path, change): ``added``, ``changed`` or ``removed``, from two listings; folders that are as they were have no row."""
    marks = ["files", "bytes", "modified"]
    a = former.select("path", F.struct(*marks).alias("_a"))
    b = now.select("path", F.struct(*marks).alias("_b"))
    change = (
        F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").when(F.col("_a") != F.col("_b"), "changed"))
    return a.join(b, "path", "full").select("path", change.alias("change")).where(F.col("change").isNotNull())


def rescan(
    catalog: DataFrame, changes: DataFrame, patterns: Sequence[str], constants: dict[str, str],
) -> DataFrame:
    """The catalog after ``changes``: only added and changed paths are parsed, removed ones leave, all other rows stay as they are."""
    kept = catalog.join(changes.select("path"), "path", "left_anti")
    fresh = catalog_rows(changes.where("change <> 'removed'").select("path"), patterns, constants)
    return kept.unionByName(fresh, allowMissingColumns=True)


def catalog_rows(paths: DataFrame, patterns: Sequence[str], constants: dict[str, str]) -> DataFrame:
    """Parse the fields of ``path`` and add constant facets; the first pattern that fits wins."""
    fields = parse_path(F.col("path"), patterns)
    parsed = paths.withColumns(fields)
    some = F.coalesce(*[F.col(f) for f in fields])
    return parsed.where(some.isNotNull()).withColumns({k: F.lit(v) for k, v in constants.items()})


def search(catalog: DataFrame, **facets: str | Sequence[str]) -> DataFrame:
    """All facets must match.  A value is one string or a list of them; a string that begins with ``^`` is a pattern."""
    for name, wanted in facets.items():
        values = [wanted] if isinstance(wanted, str) else list(wanted)
        exact = [v for v in values if not v.startswith("^")]
        cond = F.col(name).isin(exact)
        for v in values:
            if v.startswith("^"):
                cond = cond | F.col(name).rlike(v)
        catalog = catalog.where(cond)
    return catalog


def search_vars(catalog: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """Rows of the ids that offer every wanted variable at its frequency."""
    offered = catalog.select("id", "frequency", F.explode("variable").alias("v"))
    ok = None
    for var, freq in wanted.items():
        hit = (F.col("v") == var) & (F.col("frequency") == freq)
        ok = hit if ok is None else ok | hit
    complete = offered.where(ok).groupBy("id").agg(F.countDistinct("v").alias("n")).where(F.col("n") == len(wanted))
    usable = F.exists("variable", lambda v: v.isin(list(wanted))) & F.col("frequency").isin(sorted(set(wanted.values())))
    return catalog.where(usable).join(complete.select("id"), "id", "left_semi")


def covers(catalog: DataFrame, first: int, last: int, fraction: float = 0.95) -> DataFrame:
    """Rows whose dates cover at least ``fraction`` of the days of the years ``first`` to ``last``."""
    a, b = F.make_date(F.lit(first), F.lit(1), F.lit(1)), F.make_date(F.lit(last), F.lit(12), F.lit(31))
    overlap = F.datediff(F.least(F.to_date("date_end"), b), F.greatest(F.to_date("date_start"), a)) + 1
    return catalog.where(overlap >= fraction * (F.datediff(b, a) + 1))


def _first_by(catalog: DataFrame, key: str, order: Sequence[str | Column]) -> DataFrame:
    """One whole row per key, the least by ``order``; combined on the map side, so a frequent key is no burden."""
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    best = F.min_by(F.struct(*catalog.columns), F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order_cols)]))
    return catalog.groupBy(key).agg(best.alias("_r")).select("_r.*")


def finest(catalog: DataFrame, key: str = "id") -> DataFrame:
    """The row of finest resolution per id, ties by path."""
    return _first_by(catalog, key, ["resolution", "path"])


def distinct_ids(catalog: DataFrame) -> DataFrame:
    """The first row, by path, of every id."""
    return _first_by(catalog, "id", ["path"])


def exclude(catalog: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return catalog.where(F.col(column).isNull() | ~F.col(column).isin(list(values)))


def expect_one(catalog: DataFrame) -> DataFrame:
    """Raise unless exactly one row matches."""
    n = catalog.limit(2).count()
    if n != 1:
        raise ValueError("no dataset matches" if n == 0 else "more than one dataset matches")
    return catalog


def pair_hist_future(catalog: DataFrame, hist: str = "historical") -> DataFrame:
    """Future rows, each with the historical rows of its member under the future's id.

    The historical rows of a member are repeated for each of its scenarios.
    """
    future = catalog.where(F.col("experiment") != hist)
    ids = future.select("id", "experiment", *MEMBER).distinct()
    past = catalog.where(F.col("experiment") == hist).drop("id", "experiment").join(ids, list(MEMBER))
    return future.unionByName(past)


def merge_catalog(old: DataFrame, new: DataFrame, key: str = "path", on_conflict: str = "new") -> DataFrame:
    """Union of two catalogs with one row per key; the side named by ``on_conflict`` wins."""
    winner, loser = (new, old) if on_conflict == "new" else (old, new)
    rest = loser.join(winner.select(key).distinct(), key, "left_anti")
    return winner.unionByName(rest, allowMissingColumns=True)


def driving_model_key(marker: str = "GEMatm", suffix: str = "-ESMsea") -> Column:
    """The driving model as the other catalog scheme spells it: with its institution, and a suffix for one model family."""
    model = F.concat_ws("-", "driving_institution", "driving_model")
    return F.when(F.col("driving_model").contains(marker), F.concat(model, F.lit(suffix))).otherwise(model)


def padded_source() -> Column:
    return F.concat_ws("-", "institution", "source")


def lookup_with_fallback(
    members: DataFrame, first: DataFrame, second: DataFrame, keys_first: dict[str, Column], keys_second: Sequence[str]
) -> DataFrame:
    """Paths of the members: from ``first`` by derived keys, and from ``second`` for those not found there.

    ``keys_first`` maps the facets of ``first`` to expressions over ``members``.
    """
    probe = members.withColumns({f"_k_{k}": c for k, c in keys_first.items()})
    on = [F.col(f"_k_{k}") == F.col(f"_f_{k}") for k in keys_first]
    side = first.select(*[F.col(k).alias(f"_f_{k}") for k in keys_first], "path")
    found = probe.join(side, on).select(*members.columns, "path", F.lit("first").alias("catalog"))
    left = members.join(found.select("id"), "id", "left_anti")
    other = second.select(*keys_second, "path")
    return found.unionByName(left.join(other, list(keys_second)).select(*members.columns, "path", F.lit("second").alias("catalog")))


def common_variables(catalog: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """(id, variable) pairs of the wanted variables each id already has."""
    return catalog.select("id", F.explode("variable").alias("variable")).where(F.col("variable").isin(list(wanted))).distinct()


def done(catalog: DataFrame, n: int) -> DataFrame:
    """Per id and kind (``sim``, ``scen``, ``ref``): are all ``n`` properties, and but for ``ref`` all measures, there?

    ``processing_level`` is ``prop-<kind>`` or ``meas-<kind>``.  ``duplicates`` marks ids with two entries of a level,
    which the workflow treats as an error.
    """
    level = F.split("processing_level", "-")
    rows = catalog.withColumns({"what": level[0], "kind": level[1]}).where(F.col("what").isin("prop", "meas"))
    per = rows.groupBy("id", "kind").agg(
        F.count_if(F.col("what") == "prop").alias("n_prop"),
        F.count_if(F.col("what") == "meas").alias("n_meas"),
        F.max(F.when(F.col("what") == "prop", F.size("variable") == n)).alias("prop_full"),
        F.max(F.when(F.col("what") == "meas", F.size("variable") == n)).alias("meas_full"),
    )
    full = F.coalesce("prop_full", F.lit(False)) & (
        (F.col("kind") == "ref") | F.coalesce("meas_full", F.lit(False))
    )
    return per.select("id", "kind", full.alias("done"), ((F.col("n_prop") > 1) | (F.col("n_meas") > 1)).alias("duplicates"))
