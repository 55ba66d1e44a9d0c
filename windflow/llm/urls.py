"""Judging addresses by rules, and where no rule fits by the purity of their path template.

Per host the paths form a tree. Level by level, segments that are rare below their parent become a
wildcard, and branches whose labels do not differ from those of their siblings are merged into it. What is
left are the host's templates. A template is blocked if the share of its labelled pages that are good,
smoothed towards its host's and that towards all, is below a limit. Only counts are shuffled, grouped by
node: a host with a third of all pages is a few rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windflow.llm.common import Scratch

# Levels of the tree; what lies deeper becomes one wildcard.
DEPTH = 4
# A segment stays literal if so many pages, and this share of its parent's, have it.
LEAST_PAGES, LEAST_SHARE = 8, 0.05
# Labels on both sides that a comparison needs, and the deviation (squared) at which branches differ.
LEAST_LABELS, DIFFERS = 20, 3.84
# Pages' worth of the wider share in a smoothed one; a template below the limit is blocked.
WEIGHT, LIMIT = 10.0, 0.5
MOST_RULES = 200

Rule = tuple[str, str, str]  # host, path, verdict
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    return F.coalesce(F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    return F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule (`host/path`) that fits, or null."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    chosen = F.lit(None).cast("string")
    for rule_host, rule_path, _ in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        chosen = F.when(fits, rule_host + rule_path).otherwise(chosen)
    return chosen


def _counted(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"), F.count("good").alias("labelled"),
                                 F.coalesce(F.sum("good"), F.lit(0)).alias("n_good"))


def stays_literal(n, of, labelled, n_good, of_labelled, of_good) -> Column:
    """Frequent enough, and its share of good pages differs from its siblings'."""
    rest, rest_good = of_labelled - labelled, of_good - n_good
    gap = n_good / labelled - rest_good / rest
    share = of_good / of_labelled
    spread = share * (F.lit(1.0) - share) * (F.lit(1.0) / labelled + F.lit(1.0) / rest)
    frequent = (n >= LEAST_PAGES) & (n >= LEAST_SHARE * of)
    return F.when(frequent & (labelled >= LEAST_LABELS) & (rest >= LEAST_LABELS),
                  gap * gap > DIFFERS * spread).otherwise(False)


def templated(scratch: Scratch, pages: DataFrame) -> DataFrame:
    """Adds `template` to pages with `host`, `segments` and `good`; each level is written once."""
    pages = pages.withColumn("template", F.lit(""))
    for level in range(DEPTH):
        pages = scratch.table(pages.withColumn("segment", F.get("segments", F.lit(level))), f"level{level}")
        child = _counted(pages.filter("segment is not null"), "host", "template", "segment")
        parent = child.groupBy("host", "template").agg(
            F.sum("n").alias("of"), F.sum("labelled").alias("of_labelled"), F.sum("n_good").alias("of_good"))
        literal = (child.join(parent, ["host", "template"]).filter(stays_literal(*map(
            F.col, ("n", "of", "labelled", "n_good", "of_labelled", "of_good"))))
            .select("host", "template", "segment", F.lit(True).alias("literal")))
        pages = pages.join(literal, ["host", "template", "segment"], "left").withColumn(
            "template", F.when(F.col("segment").isNull(), F.col("template")).otherwise(F.concat(
                "template", F.lit("/"), F.when(F.col("literal"), F.col("segment")).otherwise("*")))).drop("literal")
    deeper = F.size("segments") > DEPTH
    return pages.withColumn("template", F.when(deeper, F.concat("template", F.lit("/**"))).otherwise(
        F.col("template"))).drop("segment")


def judged(pages: DataFrame, labels: DataFrame, rules: list[Rule], *, id_col: str = "page_id",
           url_col: str = "url") -> DataFrame:
    """`page_id, host, path, rule, verdict, template, purity` of every page.

    The host lies between the first `://` and the next `/`, `?`, `#` or the end, with A-Z lower-cased; the
    path follows, up to `?`, `#` or the end. Both are empty for a url that is null or has no `://`. A rule
    fits its host and all subdomains where the path starts with the rule's; of several the longest
    counts and its verdict stands. Other pages are blocked if their template's purity is below
    `LIMIT`, and allowed otherwise. `labels` has `page_id` and `good` (1 or 0); where it
    repeats a page, one 1 is enough. Pages without labels take part in the counts. With no labels at all purity is 1. Repeated ids are pages of
    their own and share their label; a missing id has none. An empty table gives no row.
    """
    with Scratch(pages.sparkSession) as scratch:
        chosen = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"))
        chosen = chosen.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
        known = labels.filter("page_id is not null").groupBy(F.col("page_id").cast("long").alias("page_id")).agg(
            F.max(F.col("good").cast("int")).alias("good"))
        chosen = chosen.join(known, "page_id", "left").withColumn(
            "segments", F.filter(F.split("path", "/"), lambda s: s != ""))
        pages = scratch.table(templated(scratch, chosen), "templates")
        of_template = _counted(pages, "host", "template")
        of_host = of_template.groupBy("host").agg(F.sum("labelled").alias("host_labelled"), F.sum("n_good").alias("host_good"))
        of_all = of_host.agg(F.sum("host_labelled").alias("all_labelled"), F.sum("host_good").alias("all_good"))
        overall = of_all.select(
            F.when(F.col("all_labelled") > 0, F.col("all_good") / F.col("all_labelled")).otherwise(1.0)).scalar()
        purity = (of_template.join(of_host, "host")
                  .withColumn("host_purity", (F.col("host_good") + WEIGHT * overall) / (F.col("host_labelled") + WEIGHT))
                  .select("host", "template", ((F.col("n_good") + WEIGHT * F.col("host_purity"))
                                               / (F.col("labelled") + WEIGHT)).alias("purity")))
        rule = rule_for(F.col("host"), F.col("path"), rules)
        verdicts = F.create_map(*[F.lit(x) for h, p, v in rules for x in (h + p, v)]) if rules else None
        by_rule = F.get(F.array(verdicts[F.col("rule")]), F.lit(0)) if rules else F.lit(None).cast("string")
        return scratch.result(pages.join(purity, ["host", "template"]).withColumn("rule", rule)
                .select("page_id", "host", "path", "rule",
                        F.when(F.col("rule").isNotNull(), by_rule).otherwise(
                            F.when(F.col("purity") < LIMIT, "block").otherwise("allow")).alias("verdict"),
                        "template", "purity"))


def first_lines(text: Column) -> Column:
    """The start of a text's first line, as page titles have it."""
    return F.trim(F.substring(F.substring_index(text, "\n", 1), 1, 60))


def title_of(html: Column) -> Column:
    title = F.regexp_extract(html, "<title>([^<]*)</title>", 1)
    for written, meant in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x27;", "'"), ("&#39;", "'"), ("&amp;", "&")):
        title = F.replace(title, F.lit(written), F.lit(meant))
    return F.trim(title)


def labels_by_title(pages: DataFrame, documents: DataFrame, labels: DataFrame) -> DataFrame:
    """`page_id, good`: a page is good if most labelled documents that begin with its title are of good
    quality and not toxic; even counts as good."""
    fine = ((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("int")
    lines = (documents.select("doc_id", first_lines(F.col("text")).alias("line"))
             .join(labels.select("doc_id", fine.alias("fine")).filter("fine is not null"), "doc_id")
             .filter("line <> ''").groupBy("line").agg(F.sum("fine").alias("g"), F.count("*").alias("c")))
    titles = pages.select("page_id", title_of(F.col("html")).alias("line")).filter("line <> ''")
    return titles.join(lines, "line").select("page_id", (2 * F.col("g") >= F.col("c")).cast("int").alias("good"))


def oracle(rules: list[Rule]) -> str:
    """The same in SQL, for checking."""
    fits = " ".join(
        f"WHEN (host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '{p}') THEN '{h}{p}'"
        for h, p, _ in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)))
    verdict = " ".join(f"WHEN rule = '{h}{p}' THEN '{v}'" for h, p, v in rules)
    title = "regexp_extract(html, '<title>([^<]*)</title>', 1)"
    for written, meant in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x27;", "''"), ("&#39;", "''"), ("&amp;", "&")):
        title = f"replace({title}, '{written}', '{meant}')"
    levels = []
    for k in range(DEPTH):
        levels.append(f"""
c{k} AS (SELECT host, template, segments[{k + 1}] AS segment, count(*) AS n, count(good) AS labelled,
                coalesce(sum(good), 0) AS n_good
         FROM p{k} WHERE len(segments) > {k} GROUP BY ALL),
l{k} AS (SELECT host, template, segment FROM (
           SELECT *, sum(n) OVER w AS of, sum(labelled) OVER w AS of_l, sum(n_good) OVER w AS of_g
           FROM c{k} WINDOW w AS (PARTITION BY host, template))
         WHERE n >= {LEAST_PAGES} AND n >= {LEAST_SHARE} * of AND labelled >= {LEAST_LABELS}
           AND of_l - labelled >= {LEAST_LABELS}
           AND pow(n_good::DOUBLE / labelled - (of_g - n_good)::DOUBLE / (of_l - labelled), 2) > {DIFFERS}
             * ((of_g::DOUBLE / of_l) * (1.0::DOUBLE - of_g::DOUBLE / of_l)
                * (1.0::DOUBLE / labelled + 1.0::DOUBLE / (of_l - labelled)))),
p{k + 1} AS (SELECT p.* EXCLUDE (template), CASE WHEN len(segments) <= {k} THEN p.template
                  ELSE p.template || '/' || coalesce(l.segment, '*') END AS template
         FROM p{k} p LEFT JOIN l{k} l ON p.host = l.host AND p.template = l.template AND p.segments[{k + 1}] = l.segment)""")
    return f"""
WITH lines AS (
    SELECT trim(substring(split_part(text, chr(10), 1), 1, 60)) AS line,
           sum((quality = 1 AND toxic = 0)::INT) AS g, count(*) AS c
    FROM documents JOIN labels USING (doc_id) WHERE (quality = 1 AND toxic = 0) IS NOT NULL GROUP BY 1),
known AS (SELECT page_id, max((2 * g >= c)::INT) AS good
          FROM (SELECT page_id, trim({title}) AS line FROM pages) JOIN lines USING (line)
          WHERE line <> '' AND page_id IS NOT NULL GROUP BY page_id),
cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substring(url, strpos(url, '://') + 3) END AS rest FROM pages),
split AS (SELECT page_id,
    coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM cut),
p0 AS (SELECT s.*, k.good, list_filter(string_split(path, '/'), lambda x: x <> '') AS segments, '' AS template
       FROM split s LEFT JOIN known k ON s.page_id = k.page_id),{",".join(levels)},
pages_t AS (SELECT * REPLACE (CASE WHEN len(segments) > {DEPTH} THEN template || '/**' ELSE template END AS template)
            FROM p{DEPTH}),
t AS (SELECT host, template, count(good) AS labelled, coalesce(sum(good), 0) AS n_good FROM pages_t GROUP BY ALL),
h AS (SELECT host, sum(labelled) AS host_labelled, sum(n_good) AS host_good FROM t GROUP BY ALL),
a AS (SELECT CASE WHEN sum(host_labelled) > 0 THEN sum(host_good)::DOUBLE / sum(host_labelled) ELSE 1.0 END AS overall FROM h),
q AS (SELECT host, template, (n_good + {WEIGHT}::DOUBLE * ((host_good + {WEIGHT}::DOUBLE * overall)
             / (host_labelled + {WEIGHT}::DOUBLE))) / (labelled + {WEIGHT}::DOUBLE) AS purity
      FROM t JOIN h USING (host), a),
r AS (SELECT page_id, host, path, template, purity, CASE {fits} END AS rule FROM pages_t JOIN q USING (host, template))
SELECT page_id, host, path, rule, template,
       CASE {verdict} WHEN purity < {LIMIT} THEN 'block' ELSE 'allow' END AS verdict
FROM r"""
