"""Catalog questions and dataset names."""

from __future__ import annotations

from pyspark.sql import functions as F

from graticule.functions import names as N
from graticule.sources import catalog as T

from . import fixtures as X
from .fixtures import CATALOG_SQL
from .registry import query

MEMBER = "driving_institution, driving_model, institution, source"


@query("catalog_table", f"WITH {CATALOG_SQL} SELECT id, path, frequency, date_start, date_end, len(variable) AS n_vars FROM cat")
def catalog_table(spark, d):
    return X.catalog(spark, d).select("id", "path", "frequency", "date_start", "date_end", F.size("variable").cast("bigint").alias("n_vars"))


@query("search_exact", f"WITH {CATALOG_SQL} SELECT path FROM cat WHERE experiment = 'rcp85' AND processing_level IN ('biasadjusted', 'derived')")
def search_exact(spark, d):
    return T.search(X.catalog(spark, d), experiment="rcp85", processing_level=["biasadjusted", "derived"]).select("path")


@query("search_regex", f"WITH {CATALOG_SQL} SELECT path FROM cat WHERE regexp_matches(frequency, '^[^d].*')")
def search_regex(spark, d):
    return T.search(X.catalog(spark, d), frequency="^[^d].*").select("path")


@query("search_vars", f"""WITH {CATALOG_SQL}, o AS (SELECT id, frequency, unnest(variable) AS v FROM cat),
ok AS (SELECT id FROM o WHERE frequency = 'day' AND v IN ('tasmax', 'tasmin', 'pr') GROUP BY 1 HAVING COUNT(DISTINCT v) = 3)
SELECT path FROM cat WHERE id IN (SELECT id FROM ok) AND frequency = 'day' AND len(list_intersect(variable, ['tasmax', 'tasmin', 'pr'])) > 0""")
def search_vars(spark, d):
    return T.search_vars(X.catalog(spark, d), {"tasmax": "day", "tasmin": "day", "pr": "day"}).select("path")


@query("covers_period", f"""WITH {CATALOG_SQL} SELECT path FROM cat WHERE
date_diff('day', greatest(date_start, DATE '1981-01-01'), least(date_end, DATE '2010-12-31')) + 1 >= 0.8 * (date_diff('day', DATE '1981-01-01', DATE '2010-12-31') + 1)""")
def covers_period(spark, d):
    return T.covers(X.catalog(spark, d), 1981, 2010, 0.8).select("path")


@query("finest_resolution", f"""WITH {CATALOG_SQL}, m AS (SELECT *, concat_ws('_', {MEMBER}) AS member FROM cat),
k AS (SELECT *, row_number() OVER (PARTITION BY member ORDER BY resolution, path) AS rn FROM m) SELECT member, path, resolution FROM k WHERE rn = 1""")
def finest_resolution(spark, d):
    cat = X.catalog(spark, d).withColumn("member", F.concat_ws("_", *T.MEMBER))
    return T.finest(cat, "member").select("member", "path", "resolution")


@query("distinct_ids", f"""WITH {CATALOG_SQL} SELECT id, MIN(path) AS path FROM cat GROUP BY 1""")
def distinct_ids(spark, d):
    return T.distinct_ids(X.catalog(spark, d)).select("id", "path")


@query("exclude_ids", f"WITH {CATALOG_SQL} SELECT path FROM cat WHERE institution IS NULL OR institution NOT IN ('INST1', 'INST2')")
def exclude_ids(spark, d):
    return T.exclude(X.catalog(spark, d), "institution", ["INST1", "INST2"]).select("path")


@query("member_counts", f"WITH {CATALOG_SQL} SELECT experiment, COUNT(DISTINCT id) AS members FROM cat GROUP BY 1")
def member_counts(spark, d):
    from graticule.operators.evaluate import member_counts as count
    return count(X.catalog(spark, d))


@query("pair_hist_future", f"""WITH {CATALOG_SQL} SELECT id, path, experiment FROM cat WHERE experiment <> 'historical' UNION ALL
SELECT f.id, h.path, f.experiment FROM cat h JOIN cat f USING ({MEMBER}) WHERE h.experiment = 'historical' AND f.experiment <> 'historical'""")
def pair_hist_future(spark, d):
    return T.pair_hist_future(X.catalog(spark, d)).select("id", "path", "experiment")


@query("merge_catalog_new_wins", f"""WITH {CATALOG_SQL}, n AS (SELECT path, '2.0' AS version FROM cat WHERE experiment = 'rcp45'),
o AS (SELECT path, '1.0' AS version FROM cat WHERE processing_level = 'raw')
SELECT path, version FROM n UNION ALL SELECT path, version FROM o WHERE path NOT IN (SELECT path FROM n)""")
def merge_catalog_new_wins(spark, d):
    cat = X.catalog(spark, d)
    new = cat.where("experiment = 'rcp45'").select("path", F.lit("2.0").alias("version"))
    old = cat.where("processing_level = 'raw'").select("path", F.lit("1.0").alias("version"))
    return T.merge_catalog(old, new)


@query("merge_catalog_old_wins", f"""WITH {CATALOG_SQL}, n AS (SELECT path, id FROM cat WHERE experiment = 'rcp45'),
o AS (SELECT path, frequency FROM cat WHERE processing_level = 'raw')
SELECT path, CAST(NULL AS VARCHAR) AS id, frequency FROM o UNION ALL SELECT path, id, NULL FROM n WHERE path NOT IN (SELECT path FROM o)""")
def merge_catalog_old_wins(spark, d):
    cat = X.catalog(spark, d)
    new = cat.where("experiment = 'rcp45'").select("path", "id")
    old = cat.where("processing_level = 'raw'").select("path", "frequency")
    return T.merge_catalog(old, new, on_conflict="old").select("path", "id", "frequency")


_KEYED = """m AS (SELECT id, driving_institution, driving_model, institution, source, experiment,
  concat(driving_institution, '-', driving_model, CASE WHEN contains(driving_model, 'GEMatm') THEN '-ESMsea' ELSE '' END) AS dk,
  concat(institution, '-', source) AS sk FROM cat WHERE experiment <> 'historical' AND processing_level = 'biasadjusted'),
a AS (SELECT dk AS driving_model, sk AS source, experiment, concat('/first/', id) AS path FROM m WHERE right(source, 1) IN ('1', '3', '5')),
b AS (SELECT driving_institution, driving_model, institution, source, experiment, concat('/second/', id) AS path FROM m)"""


@query("lookup_with_fallback", f"""WITH {CATALOG_SQL}, {_KEYED}, f AS (SELECT m.id, a.path FROM m JOIN a ON dk = a.driving_model AND sk = a.source AND m.experiment = a.experiment)
SELECT id, path, 'first' AS catalog FROM f UNION ALL
SELECT m.id, b.path, 'second' FROM m JOIN b USING ({MEMBER}, experiment) WHERE m.id NOT IN (SELECT id FROM f)""")
def lookup_with_fallback(spark, d):
    keys = [*T.MEMBER, "experiment"]
    m = X.catalog(spark, d).where("experiment <> 'historical' AND processing_level = 'biasadjusted'").select("id", *keys)
    first = m.where(F.right("source", F.lit(1)).isin("1", "3", "5")).select(
        T.driving_model_key().alias("driving_model"), T.padded_source().alias("source"), "experiment",
        F.concat(F.lit("/first/"), "id").alias("path"))
    second = m.select(*keys, F.concat(F.lit("/second/"), "id").alias("path"))
    by = {"driving_model": T.driving_model_key(), "source": T.padded_source(), "experiment": F.col("experiment")}
    return T.lookup_with_fallback(m, first, second, by, keys).select("id", "path", "catalog")


@query("common_variables", f"""WITH {CATALOG_SQL} SELECT DISTINCT id, v AS variable FROM (SELECT id, unnest(variable) AS v FROM cat) WHERE v IN ('tasmax', 'pr', 'rx5day')""")
def common_variables(spark, d):
    return T.common_variables(X.catalog(spark, d), ["tasmax", "pr", "rx5day"])


_LEVELS = """lv AS (SELECT source AS id, CASE c_custkey % 3 WHEN 0 THEN 'prop-sim' WHEN 1 THEN 'meas-sim' ELSE 'prop-ref' END AS processing_level, variable FROM cat)"""


@query("done_check", f"""WITH {CATALOG_SQL}, {_LEVELS}, s AS (SELECT id, split_part(processing_level, '-', 1) AS what, split_part(processing_level, '-', 2) AS kind, len(variable) = 3 AS ok FROM lv)
SELECT id, kind, COALESCE(bool_or(ok) FILTER (what = 'prop'), FALSE) AND (kind = 'ref' OR COALESCE(bool_or(ok) FILTER (what = 'meas'), FALSE)) AS done,
       COUNT(*) FILTER (what = 'prop') > 1 OR COUNT(*) FILTER (what = 'meas') > 1 AS duplicates FROM s GROUP BY 1, 2""")
def done_check(spark, d):
    level = F.expr("CASE c_custkey % 3 WHEN 0 THEN 'prop-sim' WHEN 1 THEN 'meas-sim' ELSE 'prop-ref' END")
    cat = X.catalog(spark, d).select(F.col("source").alias("id"), level.alias("processing_level"), "variable")
    return T.done(cat, 3)


_FIELDS = ("frequency", "driving_institution", "driving_model", "institution", "source", "experiment", "date_start", "date_end")
_RX = r"([^_/]+)_([^_/]+)_([^_/]+)_([^_/]+)_([^_/]+)_([^_/]+)_([^_/]+)-([^_/]+)\.parquet$"


@query("parse_paths", f"""WITH {CATALOG_SQL} SELECT path, {', '.join(f"regexp_extract(path, '{_RX}', {i}) AS {f}" for i, f in enumerate(_FIELDS, 1))},
'AMNO' AS domain, 'CMIP5' AS mip_era FROM cat WHERE regexp_matches(path, '{_RX}')""")
def parse_paths(spark, d):
    pattern = "{frequency}_{driving_institution}_{driving_model}_{institution}_{source}_{experiment}_{date_start}-{date_end}.parquet"
    return T.catalog_rows(X.catalog(spark, d).select("path"), [pattern], {"domain": "AMNO", "mip_era": "CMIP5"})


_PROP_PATH = "CASE WHEN c_custkey % 3 = 0 THEN concat('/p/', source, '_AMNO_ref_properties.parquet') ELSE concat('/p/', id, '_AMNO_sim_measures.parquet') END"


@query("parse_optional_fields", f"""WITH {CATALOG_SQL} SELECT path, driving_institution, source, domain FROM (SELECT {_PROP_PATH} AS path,
CASE WHEN c_custkey % 3 <> 0 THEN driving_institution END AS driving_institution, source, 'AMNO' AS domain FROM cat)""")
def parse_optional_fields(spark, d):
    """Several patterns in order; fields marked ``?`` are matched but not kept."""
    paths = X.catalog(spark, d).select(F.expr(_PROP_PATH).alias("path"))
    patterns = [
        "{driving_institution}_{driving_model}_{institution}_{source}_{experiment}_{domain}_{?processing_level}_{?kind}.parquet",
        "{source}_{domain}_{?processing_level}_{?kind}.parquet",
    ]
    return T.catalog_rows(paths, patterns, {}).select("path", "driving_institution", "source", "domain")


@query("format_paths", f"""WITH {CATALOG_SQL} SELECT id, concat(driving_institution, '_', driving_model, '_', institution, '_', source, '_', experiment, '_', xrfreq, '_1950-2100.parquet') AS path,
concat('/final/', experiment, '/', source, '.parquet') AS output FROM cat""")
def format_paths(spark, d):
    facets = [*T.MEMBER, "experiment", "xrfreq"]
    name = "{driving_institution}_{driving_model}_{institution}_{source}_{experiment}_{xrfreq}_1950-2100.parquet"
    return X.catalog(spark, d).select(
        "id", N.format_path(name, facets).alias("path"), N.format_path("/final/{experiment}/{source}.parquet", facets).alias("output"))


@query("split_member_id", f"""WITH {CATALOG_SQL}, s AS (SELECT id, string_split(id, '_') AS p FROM cat)
SELECT id, array_to_string(p[1:len(p) - 1], '_') AS simulation, p[len(p)] AS experiment, p[1] AS driving_institution, p[2] AS driving_model, p[3] AS institution, p[4] AS source FROM s""")
def split_member_id(spark, d):
    cat = X.catalog(spark, d).select("id")
    return cat.select("id", *[c.alias(n) for n, c in N.split_member_id(F.col("id")).items()])


@query("name_rules", f"""WITH {CATALOG_SQL} SELECT path, replace(CASE WHEN xrfreq = 'AS-JAN' THEN 'YS' ELSE xrfreq END, 'YS', 'AS-JAN') AS freq, replace(path, '/', ':') AS key,
upper(substr(id, 1, 1)) || lower(replace(substr(id, 2), '_', ' ')) AS title FROM cat""")
def name_rules(spark, d):
    pandas_freq = F.when(F.col("xrfreq") == "AS-JAN", "YS").otherwise(F.col("xrfreq"))
    return X.catalog(spark, d).select(
        "path", N.catalog_frequency(pandas_freq).alias("freq"), N.attribute_key(F.col("path")).alias("key"), N.title_of(F.col("id")).alias("title"))
