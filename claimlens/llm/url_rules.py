"""URL filtering by given host and path rules and, where none fits, by association rules mined from labelled URLs.

A URL's tokens are its host labels, its path segments (runs of digits as 0) and its query keys. Spark's FP-growth finds
the token combinations that labelled URLs share, each URL's verdict being an item of its transaction; combinations of up
to three tokens with one verdict become rules if their support and confidence suffice and no shorter rule of the same
verdict is as sure. Rules are looked up by an inverted index: each stands under its rarest token, a URL's tokens give the
candidates, and those whose tokens the URL all has match. The surest rule decides, of equals the better supported, then
the shorter, then the first by its text; without one the default does.

Registered labels: the given rules' own verdicts on the pages they fit (the table `labels` is of documents and says
nothing of pages), so the mined rules carry over to other hosts what those say of token combinations.

Scale: tokens that reach the support are at most (tokens of a URL) / SUPPORT, whatever the number of URLs, so the index
and the sets of known tokens are small; a repeated URL counts once. The count of labelled URLs, the frequent tokens and
the counters of FP-growth are all that the driver sees. FP-growth lists every frequent combination, so labelled URLs of
dozens of tokens each of which is frequent would make it list very many.

Defined results: a null URL or one without `://` has neither host nor path nor tokens, so the default decides; an empty
table gives no rows; repeated rows are judged alike; without labels, or with fewer than LEAST of them, there are no mined
rules; a null page_id stays. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import saved, table

#: (host, path, verdict): a rule fits its host and all subdomains where the path starts with its own.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
DEFAULT = "allow"
#: A rule's URLs per thousand labelled ones and their number, at least; how often it has to be right; its tokens at most.
SUPPORT, LEAST, CONFIDENCE, TOKENS = 5, 5, 0.9, 3

_PARTS = r"^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_parts(pages: DataFrame) -> DataFrame:
    """Columns host, path and tokens of the column url."""
    part = lambda i: F.coalesce(F.regexp_extract("url", "(?s)" + _PARTS, i), F.lit(""))
    out = pages.withColumns({"host": F.translate(part(1), _UPPER, _LOWER), "path": part(2), "_query": part(3)})
    some = lambda xs, name: F.transform(F.filter(xs, lambda x: x != ""), lambda x: F.concat(F.lit(name), x))
    path = F.transform(F.split("path", "/"), lambda x: F.regexp_replace(x, "[0-9]+", "0"))
    keys = F.transform(F.split("_query", "&"), lambda x: F.split(x, "=")[0])
    tokens = F.concat(some(F.split("host", r"\."), "h="), some(path, "p="), some(keys, "q="))
    return out.withColumn("tokens", F.array_sort(F.array_distinct(tokens))).drop("_query")


def fits(host: str, path: str) -> Column:
    return ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)


def with_rule(pages: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Columns rule and given: the longest rule that fits and its verdict, or nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, what in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r)):
        hit = fits(host, path)
        name, verdict = F.when(hit, host + path).otherwise(name), F.when(hit, what).otherwise(verdict)
    return pages.withColumns({"rule": name, "given": verdict})


def mine(labelled: DataFrame, support: int = SUPPORT, least: int = LEAST, confidence: float = CONFIDENCE, longest: int = TOKENS) -> tuple[DataFrame, list[str]]:
    """labelled (url, tokens, verdict) -> the rules (items, verdict, n, confidence, anchor) and the tokens they are made of."""
    spark = labelled.sparkSession
    rows = saved(labelled.dropDuplicates(["url"]).select("verdict", F.array_append("tokens", F.concat(F.lit("="), F.col("verdict"))).alias("items")))
    n = rows.count()
    count = max(least, -(-n * support // 1000))
    if n < count:
        return spark.sql("SELECT array('') AS items, '' AS verdict, 0L AS n, 0D AS confidence, '' AS anchor WHERE FALSE"), []
    # half a row below the count, so that it is the ceiling whatever the division rounds to
    fitted = FPGrowth(itemsCol="items", minSupport=(count - 0.5) / n, minConfidence=confidence).fit(rows)
    found = saved(fitted.freqItemsets.where(F.size("items") <= longest + 1))
    verdict = F.filter("items", lambda x: x.startswith("="))
    found = found.select(F.array_sort(F.filter("items", lambda x: ~x.startswith("="))).alias("items"), F.substring(F.get(verdict, F.lit(0)), 2, 1 << 20).alias("verdict"), F.col("freq").alias("n")).where(F.size("items").between(1, longest))
    total = found.where("verdict is null").select(F.col("items").alias("_items"), F.col("n").alias("_n"))
    sure = found.where("verdict is not null").join(total, F.col("items") == F.col("_items")).withColumn("confidence", F.col("n") / F.col("_n")).where(F.col("confidence") >= confidence)
    sure = sure.select("items", "verdict", "n", "confidence")
    parts = F.expr("case when size(items) > 1 then transform(sequence(1, shiftleft(1, size(items)) - 2), m -> filter(items, (x, i) -> (shiftright(m, i) & 1) = 1)) else array() end")
    shorter = sure.select(F.col("items").alias("_short"), F.col("verdict").alias("_verdict"), F.col("confidence").alias("_sure"))
    within = sure.select("items", "verdict", "confidence", F.explode(parts).alias("_part"))
    idle = within.join(shorter, (F.col("_part") == F.col("_short")) & (F.col("verdict") == F.col("_verdict")) & (F.col("_sure") >= F.col("confidence"))).select(F.col("items").alias("_idle"), F.col("verdict").alias("_of")).distinct()
    kept = saved(sure.join(idle, (F.col("items") == F.col("_idle")) & (F.col("verdict") == F.col("_of")), "left_anti"))
    single = total.where(F.size("_items") == 1).select(F.col("_items")[0].alias("_token"), "_n")
    anchors = kept.select("items", F.explode("items").alias("token")).distinct().join(single, F.col("token") == F.col("_token"))
    anchors = anchors.groupBy(F.col("items").alias("_of")).agg(F.min_by("token", F.struct("_n", "token")).alias("anchor"))
    index = saved(kept.join(anchors, F.col("items") == F.col("_of")).drop("_of"))
    # frequent tokens: as many as a URL has, times 1000 / SUPPORT, at most
    known = sorted(r[0] for r in index.select(F.explode("items")).distinct().collect())
    return index, known


def matched(sets: DataFrame, index: DataFrame) -> DataFrame:
    """sets (known, distinct) -> known and best, the surest rule (items, verdict, confidence) that it holds."""
    rules = index.select(F.col("anchor"), F.struct("items", "verdict", "n", "confidence").alias("_rule"))
    found = sets.select("known", F.explode("known").alias("_token")).join(rules, F.col("_token") == F.col("anchor"))
    found = found.where(F.size(F.array_except("_rule.items", "known")) == 0)
    order = F.struct(-F.col("_rule.confidence"), -F.col("_rule.n"), F.size("_rule.items"), F.array_join("_rule.items", " & "), F.col("_rule.verdict"))
    return found.groupBy("known").agg(F.min_by("_rule", order).alias("best"))


def judged(pages: DataFrame, rules: list[tuple[str, str, str]] | None = None, labelled: DataFrame | None = None, default: str = DEFAULT) -> DataFrame:
    """pages (page_id, url) -> page_id, host, path, rule, verdict, mined (the tokens of the mined rule that decides) and
    its confidence. labelled (url, verdict) are what rules are mined from; without it, the pages that given rules fit."""
    rows = with_rule(with_parts(pages.select("page_id", "url")), RULES if rules is None else rules)
    source = rows.where("given is not null").select("url", "tokens", F.col("given").alias("verdict"))
    if labelled is not None:
        source = with_parts(labelled.where("url is not null and verdict is not null").select("url", "verdict")).select("url", "tokens", "verdict")
    index, known = mine(source)
    rows = rows.withColumn("known", F.when(F.col("given").isNull(), F.filter("tokens", lambda t: t.isin(known) if known else F.lit(False))))
    # written, so that Spark broadcasts it if it is small and splits URLs of a common set if it isn't
    best = saved(matched(rows.where("size(known) > 0").select("known").distinct(), index)).withColumnRenamed("known", "_known")
    out = rows.join(best, F.col("known") == F.col("_known"), "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("given", "best.verdict", F.lit(default)).alias("verdict"), F.array_join("best.items", " & ").alias("mined"), F.round("best.confidence", 6).alias("confidence"))


def op11(spark, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages"))


def _sql() -> str:
    fit = lambda h, p: f"(host = '{h}' OR suffix(host, '.{h}')) AND starts_with(path, '{p}')"
    longest = sorted(RULES, key=lambda r: (-len(r[0]) - len(r[1]), r))
    case = lambda of: "CASE " + " ".join(f"WHEN {fit(h, p)} THEN '{of(h, p, v)}'" for h, p, v in longest) + " END"
    part = lambda i: f"coalesce(regexp_extract(url, '(?s){_PARTS}', {i}), '')"
    some = lambda xs, name: f"list_transform(list_filter({xs}, lambda x: x <> ''), lambda x: '{name}' || x)"
    path = "list_transform(string_split(path, '/'), lambda x: regexp_replace(x, '[0-9]+', '0', 'g'))"
    keys = "list_transform(string_split(q, '&'), lambda x: string_split(x, '=')[1])"
    return f"""
WITH u AS (SELECT page_id, url, translate({part(1)}, '{_UPPER}', '{_LOWER}') AS host, {part(2)} AS path, {part(3)} AS q FROM pages),
p AS (SELECT page_id, url, host, path, {case(lambda h, p, v: h + p)} AS rule, {case(lambda h, p, v: v)} AS given,
 list_sort(list_distinct(list_concat(list_concat({some("string_split(host, '.')", 'h=')}, {some(path, 'p=')}), {some(keys, 'q=')}))) AS tokens FROM u),
lab AS (SELECT url, any_value(tokens) AS tokens, any_value(given) AS verdict FROM p WHERE given IS NOT NULL GROUP BY url),
one AS (SELECT url, verdict, tokens, unnest(tokens) AS a FROM lab),
two AS (SELECT url, verdict, tokens, a, unnest(list_filter(tokens, lambda x: x > a)) AS b FROM one),
three AS (SELECT url, verdict, a, b, unnest(list_filter(tokens, lambda x: x > b)) AS c FROM two),
combos AS (SELECT verdict, [a] AS items FROM one UNION ALL SELECT verdict, [a, b] FROM two UNION ALL SELECT verdict, [a, b, c] FROM three),
per AS (SELECT items, verdict, count(*) AS n FROM combos GROUP BY 1, 2),
sure AS (SELECT items, verdict, n, n / total AS confidence FROM (SELECT *, CAST(sum(n) OVER (PARTITION BY items) AS DOUBLE) AS total FROM per)
 WHERE n >= (SELECT greatest({LEAST}, (count(*) * {SUPPORT} + 999) // 1000) FROM lab) AND n / total >= {CONFIDENCE}),
kept AS (SELECT * FROM sure r WHERE NOT EXISTS (SELECT 1 FROM sure s WHERE s.verdict = r.verdict AND len(s.items) < len(r.items) AND list_has_all(r.items, s.items) AND s.confidence >= r.confidence)),
best AS (SELECT * FROM (SELECT t.tokens, k.*, row_number() OVER (PARTITION BY t.tokens ORDER BY confidence DESC, n DESC, len(items), array_to_string(items, ' & '), verdict) AS i
 FROM (SELECT DISTINCT tokens FROM p WHERE given IS NULL) t JOIN kept k ON list_has_all(t.tokens, k.items)) WHERE i = 1)
SELECT page_id, host, path, rule, coalesce(given, best.verdict, '{DEFAULT}') AS verdict, array_to_string(best.items, ' & ') AS mined, round(best.confidence, 6) AS confidence
FROM p LEFT JOIN best ON p.given IS NULL AND best.tokens = p.tokens
"""


SQL = _sql()
