"""URL verdicts: listed rules first, then the purity of the URL's path template on its host.

Paths of each host form a tree of segments. Level by level, a segment stays literal if ``MIN_COUNT`` URLs have it below
its parent, and becomes the wildcard ``*`` otherwise: ids, dates and names melt together, fixed parts of the site
stay, however large the host is. Levels run to the end of the longest path; where no parent has ``MIN_COUNT``
URLs any more, all further segments are wildcards. Sibling templates whose labelled purities do not differ significantly (two-proportion test,
``ALIKE_Z``) from all that the branch holds, and from its purest member, are merged into one branch. A branch's purity is its share of bad labels, smoothed towards
its host's share, which is smoothed towards the corpus; a template without labels takes the share of all its
siblings, smoothed alike. Branches above ``REJECT`` are blocked.

The labels come from a table of judged items whose ids are page ids; an item is bad if it is of low quality
or toxic. Verdicts of listed rules are no labels: they cover whole domains, so purities learned from them
would spread those domains' verdicts over all others. Levels are aggregations with partial sums, so a host with
a third of all URLs is summed in every task.

Defined results: a null url, or one without ``://``, has an empty host and path and is judged like the pages of a host
named by the empty string. Rows that repeat a url count as often as they occur. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.staging import staged

MIN_COUNT = 8
# For plain statements of the templates only: the code has no bound on the levels and asks for no share of the parent.
LEVELS = 64
MIN_SHARE = 0.0
ALIKE_Z = 1.96
PURITY_STEPS = 1024  # siblings of one purity step and size are compared as one
SMOOTHING = 8.0  # pseudo-URLs of the wider level
REJECT = 0.5

# Fixed values of the listed rules: (verdict, host and path).
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, F.lit("://")) + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _CAPITALS, _SMALL)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return host, path


def listed_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda r: len(r[1])):
        domain, slash, tail = text.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + tail)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, said).otherwise(verdict)
    return rule, verdict


def _templates(pages: DataFrame) -> DataFrame:
    """Adds ``template``: the path with variable segments replaced, one level at a time."""
    parts = F.filter(F.split("path", "/"), lambda s: s != "")
    rows = pages.withColumn("parts", parts).withColumn("template", F.lit(""))
    done, level = [], 0
    while True:
        rows = staged(rows, "level")
        done.append(rows.where(F.size("parts") <= level))
        rows = rows.where(F.size("parts") > level).withColumn("segment", F.get("parts", F.lit(level)))
        counts = staged(rows.groupBy("host", "template", "segment").agg(F.count("*").alias("n")), "segments")
        largest = counts.groupBy("host", "template").agg(F.sum("n").alias("of")).agg(F.max("of")).first()[0]
        if largest is None or largest < MIN_COUNT:
            break
        literal = counts.where(F.col("n") >= MIN_COUNT).select("host", "template", "segment", F.lit(True).alias("literal"))
        rows = rows.join(literal, ["host", "template", "segment"], "left")
        step = F.concat(F.lit("/"), F.when(F.col("literal"), F.col("segment")).otherwise("*"))
        rows = rows.withColumn("template", F.concat("template", step)).drop("segment", "literal")
        level += 1
    rest = F.array_join(F.array_repeat(F.lit("/*"), F.size("parts") - level), "")
    found = rows.withColumn("template", F.concat("template", rest)).drop("segment")
    for part in done:
        found = found.unionByName(part)
    tail = F.when(F.col("path").endswith("/") & (F.size("parts") > 0), "/").otherwise("")
    return found.withColumn("template", F.concat("template", tail)).drop("parts")


def _parent() -> Column:
    return F.regexp_replace("template", r"/[^/]*/?$", "")


def _branches(templates: DataFrame) -> DataFrame:
    """(host, parent, template, branch, labelled, bad): siblings of like purity share a branch.

    Siblings are the labelled templates of one host and parent. Those of like purity (``PURITY_STEPS``) and size (powers of
    two) are summed first, so a parent has a bounded number of entries, whatever its number of children. In order of
    purity, an entry joins the branch built so far unless its average member differs significantly from the
    branch's pooled counts or from its first entry's average member; small siblings make no bridge between large ones.
    """
    n, b = F.col("labelled"), F.col("bad")
    seen = templates.where("labelled > 0").withColumn("parent", _parent())
    seen = seen.withColumn("step", F.floor(b * PURITY_STEPS / n).cast("int")).withColumn("size", -F.floor(F.log2(n)).cast("int"))
    entries = seen.groupBy("host", "parent", "step", "size").agg(F.count("*").alias("times"), F.sum(n).alias("n"), F.sum(b).alias("b"))
    entries = entries.groupBy("host", "parent").agg(F.array_sort(F.collect_list(F.struct("step", "size", "times", "n", "b"))).alias("entries"))

    def differs(n1: Column, b1: Column, n2: Column, b2: Column) -> Column:
        pooled = (b1 + b2) / (n1 + n2)
        return (b2 / n2 - b1 / n1) > ALIKE_Z * F.sqrt(F.greatest(pooled * (1 - pooled), F.lit(0.0)) * (1 / n1 + 1 / n2))

    def grown(branches: Column, x: Column) -> Column:
        last, m, k = F.get(branches, F.size(branches) - 1), x["n"] / x["times"], x["b"] / x["times"]
        apart = (F.size(branches) == 0) | differs(last["n"], last["b"], m, k) | differs(last["m"], last["k"], m, k)
        new = F.struct(x["step"].alias("step"), x["size"].alias("size"), x["n"].alias("n"), x["b"].alias("b"), m.alias("m"), k.alias("k"))
        both = F.struct(
            last["step"].alias("step"), last["size"].alias("size"), (last["n"] + x["n"]).alias("n"), (last["b"] + x["b"]).alias("b"),
            last["m"].alias("m"), last["k"].alias("k"),
        )
        return F.when(apart, F.concat(branches, F.array(new))).otherwise(F.concat(F.slice(branches, F.lit(1), F.size(branches) - 1), F.array(both)))

    none = F.array().cast("array<struct<step:int,size:int,n:bigint,b:bigint,m:double,k:double>>")
    folded = staged(entries.select("host", "parent", F.aggregate("entries", none, grown).alias("branches")), "branches")
    upto = F.filter("branches", lambda x: (x["step"] < F.col("step")) | ((x["step"] == F.col("step")) & (x["size"] <= F.col("size"))))
    found = seen.select("host", "parent", "template", "step", "size").join(folded, ["host", "parent"]).withColumn("upto", upto)
    own = F.get("upto", F.size("upto") - 1)
    return found.select("host", "parent", "template", F.size("upto").alias("branch"), own["n"].alias("labelled"), own["b"].alias("bad"))


def template_verdicts(pages: DataFrame, label: str) -> DataFrame:
    """``pages`` (host, path, ``label`` 1 bad / 0 good / null unknown) with template, purity and template_verdict."""
    rows = staged(_templates(pages), "templates")
    labelled = F.count(label).alias("labelled"), F.coalesce(F.sum(F.col(label).cast("long")), F.lit(0)).alias("bad")
    templates = staged(rows.groupBy("host", "template").agg(*labelled), "template-labels")
    totals = templates.agg(F.sum("labelled").alias("n"), F.sum("bad").alias("b")).first()
    corpus = (totals.b / totals.n) if totals.n else 0.0
    hosts = templates.groupBy("host").agg(F.sum("labelled").alias("n"), F.sum("bad").alias("b"))
    hosts = hosts.select("host", ((F.col("b") + SMOOTHING * corpus) / (F.col("n") + SMOOTHING)).alias("host_purity"))
    branches = _branches(templates)
    parents = branches.select("host", "parent", "branch", "labelled", "bad").distinct()
    parents = parents.groupBy("host", "parent").agg(F.sum("labelled").alias("all_labelled"), F.sum("bad").alias("all_bad"))
    known = templates.select("host", "template", _parent().alias("parent")).join(branches.drop("parent"), ["host", "template"], "left")
    known = known.join(parents, ["host", "parent"], "left").join(hosts, "host")
    n, b = F.coalesce("labelled", "all_labelled", F.lit(0)), F.coalesce("bad", "all_bad", F.lit(0))
    known = known.select("host", "template", ((b + SMOOTHING * F.col("host_purity")) / (n + SMOOTHING)).alias("purity"))
    known = staged(known, "template-purities")
    verdict = F.when(F.col("purity") > REJECT, "block").otherwise("allow")
    return rows.join(known, ["host", "template"]).withColumn("template_verdict", verdict)


def judged(pages: DataFrame, labels: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) for every page; unlisted URLs get their template's verdict.

    ``labels`` has (doc_id, quality, toxic); an id that repeats is bad if any of its rows is, null counts as good.
    """
    host, path = host_and_path(F.col("url"))
    rule, said = listed_rule(F.col("host"), F.col("path"), rules)
    rows = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("rule", rule).withColumn("listed", said)
    bad = F.coalesce((F.col("quality") == 0) | (F.col("toxic") == 1), F.lit(False))
    known = labels.groupBy(F.col("doc_id").alias("labelled_id")).agg(F.max(bad.cast("int")).alias("label"))
    rows = rows.join(known, F.col("page_id") == F.col("labelled_id"), "left").drop("labelled_id")
    found = template_verdicts(rows, "label")
    return found.select("page_id", "host", "path", "rule", F.coalesce("listed", "template_verdict").alias("verdict"), "template", "purity")
