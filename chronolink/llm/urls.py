"""URL filters by host-suffix and path-prefix expressions.

Every address is expanded into the expressions (host suffix, path prefix) that some rule could be
written as: suffixes with as many labels, prefixes with as many characters as any rule has. Expressions
meet the rules in an equi-join on four bytes of their digest; the full digest then confirms the match,
and the most exact rule decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import ascii_lower, read

#: The rules of the query (host, path, verdict).
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
#: The verdict where no rule fits.
DEFAULT = "allow"
#: Hexadecimal digits of the digest that the join compares.
SHORT = 8


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    """Rules as a table (rule_host, rule_path, rule_verdict)."""
    schema = "rule_host string, rule_path string, rule_verdict string"
    if not rules:
        return spark.range(0).selectExpr(
            "'' as rule_host", "'' as rule_path", "'' as rule_verdict"
        )
    one = [F.struct(*[F.lit(value) for value in rule]) for rule in rules]
    names = [part.split()[0] for part in schema.split(", ")]
    return spark.range(1).select(F.explode(F.array(*one)).alias("_")).select("_.*").toDF(*names)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of an address; both empty for null or without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 1)
    return ascii_lower(host), F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 2)


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, path), 256)


def judge(pages: DataFrame, rules: DataFrame, *, url: str = "url", default: str = DEFAULT) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict``; columns of these names are replaced.

    A rule fits its host and all subdomains where the path starts with the rule's. The rule with the
    longest host wins, then that with the longest path; of equal rules a blocking one. Without a fit
    ``rule`` is null and ``verdict`` is ``default``. A null address, or one without ``://``, has empty
    host and path. Repeated rows each get their verdict; an empty table gives an empty table.
    """
    known = rules.select(
        ascii_lower(F.col("rule_host")).alias("rule_host"), "rule_path", "rule_verdict"
    ).dropDuplicates()
    # Two short lists, bounded by the longest host and path of a rule.
    shape = known.agg(
        F.sort_array(F.collect_set(F.size(F.split("rule_host", r"\.")))),
        F.sort_array(F.collect_set(F.length("rule_path"))),
    ).first()
    known = known.withColumn("_full", _digest(F.col("rule_host"), F.col("rule_path")))
    known = known.withColumn("_short", F.substring("_full", 1, SHORT))

    host, path = host_and_path(F.col(url))
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    parted = pages.select(*kept, host.alias("host"), path.alias("path"))

    # Each address is judged once, however often it comes.
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.filter(F.lit(shape[0]), lambda n: n <= F.size(labels)),
        lambda n: F.concat_ws(".", F.slice(labels, F.size(labels) - n + 1, n)),
    )
    prefixes = F.transform(
        F.filter(F.lit(shape[1]), lambda n: n <= F.length("path")),
        lambda n: F.col("path").substr(F.lit(1), n),
    )
    decided = (
        parted.select("host", "path")
        .filter("host <> ''")
        .distinct()
        .withColumn("_suffix", F.explode(suffixes))
        .withColumn("_prefix", F.explode(prefixes))
        .withColumn("_digest", _digest(F.col("_suffix"), F.col("_prefix")))
        .withColumn("_short", F.substring("_digest", 1, SHORT))
        .join(known, "_short")
        .filter("_digest = _full and _suffix = rule_host and _prefix = rule_path")
        .groupBy("host", "path")
        .agg(
            F.max(
                F.struct(
                    F.length("rule_host").alias("hosts"),
                    F.length("rule_path").alias("paths"),
                    F.col("rule_verdict").alias("verdict"),
                    F.concat("rule_host", "rule_path").alias("rule"),
                )
            ).alias("_best")
        )
    )
    return parted.join(decided, ["host", "path"], "left").select(
        *kept,
        "host",
        "path",
        F.col("_best.rule").alias("rule"),
        F.coalesce("_best.verdict", F.lit(default)).alias("verdict"),
    )


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, rule_table(spark)).drop("url")


ORACLE = f"""
with parted as (
  select page_id,
    case when contains(url, '://') then substr(url, instr(url, '://') + 3) else '' end as rest
  from pages),
named as (
  select page_id,
    translate(regexp_extract(rest, '^([^/?#]*)([^?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^([^/?#]*)([^?#]*)', 2) as path
  from parted),
rules(rule_host, rule_path, rule_verdict) as (values {", ".join(repr(r) for r in RULES)}),
fitting as (
  select page_id, host, path, rule_host || rule_path as rule, rule_verdict,
    row_number() over (partition by page_id
      order by length(rule_host) desc nulls last, length(rule_path) desc) as place
  from named left join rules
    on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path))
select page_id, host, path, rule, coalesce(rule_verdict, '{DEFAULT}') as verdict
from fitting where place = 1
"""
