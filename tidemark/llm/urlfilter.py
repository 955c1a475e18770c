"""URL filter: rules by host and path, and for what no rule fits a character language-model ratio (DataFrame only).

Two smoothed variable-order Markov models are counted, one over the URLs that rules accept and one over those that
they reject. Each symbol is predicted from up to `ORDER` symbols before it; the orders are interpolated by
Witten-Bell's estimate. A URL's score is the mean over its symbols of ln P(accepted) - ln P(rejected). The threshold
is calibrated on a tenth of the ruled URLs that the models haven't seen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._base import BROADCAST_ROWS, ascii_lower, cut, read

#: Symbols of context; symbols that the models know: printable ASCII without A-Z, one for all others, and the end.
ORDER, SYMBOLS = 3, 70
#: Stand for what is before the first symbol, after the last, and for anything but printable ASCII.
START, END, OTHER = "\x02", "\x03", "\x7f"
#: (verdict, host and path) as the contract states them.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL as they stand; both are empty for null and without `://`."""
    at = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    return ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, rules=RULES) -> Column:
    """A struct (rule, verdict) of the longest rule that fits, null if none does. A rule's host is everything before
    its first slash; it fits that host and its subdomains. rules: a short list, tried from the longest on."""
    out = None
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1], r[0])):
        name, _, start = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{start}")
        hit = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, hit) if out is None else out.when(fits, hit)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def symbols(url: Column) -> Column:
    """The gram of each symbol: the symbol behind the ORDER symbols before it; the end counts as a symbol. Null and
    empty URLs have the end alone."""
    text = F.regexp_replace(ascii_lower(F.coalesce(url, F.lit(""))), "[^!-~]", OTHER)
    padded = F.concat(F.lit(START * ORDER), text, F.lit(END))
    return F.regexp_extract_all(padded, F.lit(f"(?s)(?=(.{{{ORDER + 1}}}))"), F.lit(1))  # overlapping, in one pass


def count_grams(urls: DataFrame) -> DataFrame:
    """(gram, allow, block): how often each gram occurs in urls(url, verdict); counted where the rows lie first."""
    grams = urls.select("verdict", F.explode(symbols(F.col("url"))).alias("gram"))
    return grams.groupBy("gram").agg(F.count_if(F.col("verdict") == "allow").alias("allow"), F.count_if(F.col("verdict") == "block").alias("block"))


def log_ratios(counts: DataFrame, wanted: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(gram, micro) for every gram of wanted: a millionth's multiple of ln P(last symbol | accepted) minus ln P(..|
    rejected). Whole numbers, so that sums don't depend on their order. Without counts all ratios are 0.

    The tables of lower orders are no larger than counts, so one count decides whether all are broadcast."""
    hint = F.broadcast if counts.limit(broadcast_rows + 1).count() <= broadcast_rows else lambda df: df
    out = wanted.select("gram").distinct()
    p = {c: F.lit(1.0 / SYMBOLS) for c in ("allow", "block")}
    for order in range(ORDER + 1):
        gram = F.substr(F.col("gram"), F.lit(ORDER + 1 - order))
        own = counts.groupBy(gram.alias("key")).agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))
        context = own.groupBy(F.substr(F.col("key"), F.lit(1), F.lit(order)).alias("ctx")).agg(*[
            e for c in ("allow", "block") for e in (F.sum(c).alias(f"n_{c}"), F.count_if(F.col(c) > 0).alias(f"t_{c}"))])
        out = out.withColumns({"key": gram, "ctx": F.substr(gram, F.lit(1), F.lit(order))})
        out = out.join(hint(own), "key", "left").join(hint(context), "ctx", "left")
        for c in ("allow", "block"):
            n, t = F.coalesce(f"n_{c}", F.lit(0)), F.coalesce(f"t_{c}", F.lit(0))
            p[c] = F.when(n > 0, (F.coalesce(c, F.lit(0)) + t * p[c]) / (n + t)).otherwise(p[c])
        out = out.select("gram", p["allow"].alias("p_allow"), p["block"].alias("p_block"))
        p = {c: F.col(f"p_{c}") for c in p}
    micro = F.round((F.log("p_allow") - F.log("p_block")) * 1e6).cast("long")
    return out.select("gram", micro.alias("micro"))


def scores(urls: DataFrame, ratios: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(rid, micro): mean log ratio of the symbols of each URL of urls(rid, url), rounded down to millionths."""
    few = ratios.limit(broadcast_rows + 1).count() <= broadcast_rows  # else by shuffle, hot grams split by AQE
    each = urls.select("rid", F.explode(symbols(F.col("url"))).alias("gram")).join(F.broadcast(ratios) if few else ratios, "gram")
    return each.groupBy("rid").agg(F.floor(F.sum("micro") / F.count("*")).alias("micro"))


def calibrated(known: DataFrame) -> int:
    """The threshold, in thousandths, from which known(verdict, micro) counts as accepted: the greatest sum of the
    shares of accepted URLs at or above it and of rejected ones below it. Ties go to the threshold nearest 0, then to
    the smaller; 0 if one class is empty. A histogram of thousandths is all that is looked at."""
    bins = known.groupBy(F.floor(F.col("micro") / 1000).alias("b")).agg(F.count_if(F.col("verdict") == "allow").alias("a"), F.count_if(F.col("verdict") == "block").alias("r"))
    bins = bins.unionByName(known.sparkSession.createDataFrame([(0, 0, 0)], "b long, a long, r long")).groupBy("b").agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
    whole, below = Window.partitionBy(), Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)  # one row per bin
    big = lambda c: c.cast("decimal(19,0)")
    all_a, all_r = F.sum("a").over(whole), F.sum("r").over(whole)
    a_below, r_below = F.coalesce(F.sum("a").over(below), F.lit(0)), F.coalesce(F.sum("r").over(below), F.lit(0))
    gain = big(all_a - a_below) * big(all_r) + big(r_below) * big(all_a)
    best = bins.select("b", F.when((all_a > 0) & (all_r > 0), gain).otherwise(F.lit(0).cast("decimal(38,0)")).alias("gain")).orderBy(F.desc("gain"), F.abs("b"), "b").first()
    return best["b"] if best["gain"] else 0


def judge_urls(pages: DataFrame, rules=RULES, id: str = "page_id", url: str = "url") -> DataFrame:
    """One row per page: id, host, path, rule, verdict, score (null where a rule decides).

    Null and empty URLs have no host and no rule; the models judge their end symbol. Repeated rows each count and get
    a row each. Without accepted or without rejected URLs the threshold is 0 and, with no counts at all, every score
    is 0 and every verdict `allow`. An empty table gives an empty one. Other columns of pages are never read.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col(id).alias("id"), F.col(url).alias("url")).withColumns({"host": host, "path": path})
    rows = rows.withColumn("by", ruled(F.col("host"), F.col("path"), rules)).select("id", "url", "host", "path", "by.rule", "by.verdict", F.monotonically_increasing_id().alias("rid"))
    rows = cut(rows, "urls")
    held = F.conv(F.substring(F.md5(F.col("url").cast("binary")), 1, 6), 16, 10).cast("long") % 10 == 0
    counts = cut(count_grams(rows.where(F.col("verdict").isNotNull() & ~held)), "grams")
    scored = rows.where(F.col("verdict").isNull() | held)
    wanted = scored.select(F.explode(symbols(F.col("url"))).alias("gram"))
    ratios = cut(log_ratios(counts, wanted), "ratios")
    found = cut(scores(scored.select("rid", "url"), ratios).join(rows.select("rid", "verdict"), "rid"), "scores")
    least = calibrated(found.where("verdict is not null"))
    mine = found.where("verdict is null").select("rid", "micro")
    by_model = F.when(F.floor(F.col("micro") / 1000) >= least, "allow").otherwise("block")
    return rows.join(mine, "rid", "left").select(F.col("id").alias(id), "host", "path", "rule", F.coalesce("verdict", by_model).alias("verdict"), (F.col("micro") / 1e6).alias("score"))


def op11_url_filter(spark, sf_dir):
    """The verdict on every page's URL by the contract's rules, else by the models."""
    return judge_urls(read(spark, sf_dir, "pages"))


def _oracle() -> str:
    lower = "translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    cases = []
    for verdict, rule in sorted(RULES, key=lambda r: -len(r[1])):
        name, _, start = rule.partition("/")
        cases.append((f"(host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '/{start}')", rule, verdict))
    rule = " ".join(f"WHEN {c} THEN '{r}'" for c, r, _ in cases)
    verdict = " ".join(f"WHEN {c} THEN '{v}'" for c, _, v in cases)
    lm, last = "", "w"
    for k in range(ORDER + 1):
        before = {c: f"p_{c}" if k else f"{1.0 / SYMBOLS!r}" for c in ("a", "r")}
        p = ", ".join(f"CASE WHEN coalesce(n_{c}, 0) > 0 THEN (coalesce({c}, 0) + t_{c} * {before[c]}) / (n_{c} + t_{c}) ELSE {before[c]} END AS p_{c}" for c in ("a", "r"))
        lm += f"""
own{k} AS (SELECT substr(gram, {ORDER + 1 - k}) AS key, sum(a) AS a, sum(r) AS r FROM counts GROUP BY ALL),
ctx{k} AS (SELECT substr(key, 1, {k}) AS ctx, sum(a) AS n_a, sum(r) AS n_r, count(*) FILTER (a > 0) AS t_a, count(*) FILTER (r > 0) AS t_r FROM own{k} GROUP BY ALL),
lm{k} AS (SELECT gram, {p} FROM (SELECT *, substr(gram, {ORDER + 1 - k}) AS key, substr(gram, {ORDER + 1 - k}, {k}) AS ctx FROM {last}) LEFT JOIN own{k} USING (key) LEFT JOIN ctx{k} USING (ctx)),"""
        last = f"lm{k}"
    return rf"""
WITH u AS (SELECT row_number() OVER () AS rid, page_id, url, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT *, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
j AS MATERIALIZED (SELECT *, CASE {rule} END AS rule, CASE {verdict} END AS ruled, coalesce(('0x' || substr(md5(url), 1, 6))::BIGINT % 10 = 0, false) AS held,
      repeat(chr(2), {ORDER}) || regexp_replace({lower}, '[^!-~]', chr(127), 'g') || chr(3) AS padded FROM h),
g AS MATERIALIZED (SELECT rid, ruled, held, unnest(list_transform(range(1, length(padded) - {ORDER} + 1), lambda p: substr(padded, p, {ORDER + 1}))) AS gram FROM j),
counts AS MATERIALIZED (SELECT gram, count(*) FILTER (ruled = 'allow') AS a, count(*) FILTER (ruled = 'block') AS r FROM g WHERE ruled IS NOT NULL AND NOT held GROUP BY gram),
w AS (SELECT DISTINCT gram FROM g WHERE ruled IS NULL OR held),{lm}
ratio AS MATERIALIZED (SELECT gram, round((ln(p_a) - ln(p_r)) * 1e6)::BIGINT AS micro FROM {last}),
s AS MATERIALIZED (SELECT rid, any_value(ruled) AS ruled, floor(sum(micro)::DOUBLE / count(*)) AS micro FROM g JOIN ratio USING (gram) WHERE ruled IS NULL OR held GROUP BY rid),
bins AS (SELECT b, sum(a) AS a, sum(r) AS r FROM (SELECT floor(micro / 1000) AS b, count(*) FILTER (ruled = 'allow') AS a, count(*) FILTER (ruled = 'block') AS r FROM s WHERE ruled IS NOT NULL GROUP BY 1 UNION ALL SELECT 0, 0, 0) GROUP BY b),
gains AS (SELECT b, (sum(a) OVER (ORDER BY b DESC)) * (sum(r) OVER ()) + (sum(r) OVER (ORDER BY b) - r) * (sum(a) OVER ()) AS gain, sum(a) OVER () > 0 AND sum(r) OVER () > 0 AS both_there FROM bins),
t AS (SELECT coalesce((SELECT b FROM gains WHERE both_there ORDER BY gain DESC, abs(b), b LIMIT 1), 0) AS least)
SELECT page_id, host, path, rule, coalesce(j.ruled, CASE WHEN floor(micro / 1000) >= (SELECT least FROM t) THEN 'allow' ELSE 'block' END) AS verdict,
       CASE WHEN j.ruled IS NULL THEN micro / 1e6 END AS score
FROM j LEFT JOIN s USING (rid)
"""


OP11_SQL = _oracle()
