"""URL filter by association rules; DataFrame functions only.

A URL is split into tokens: the parts of its host, its path segments (digits made alike), the kind of its
end, and the keys of its query, all of them. Spark's FP-growth mines token combinations that go with the
label ``block`` or ``allow``; URLs without a label are mined too, and lower the confidence of what they
share. Rules below the support and confidence asked for are pruned, and so are those that a shorter
rule makes needless. The rest form an inverted index from each rule's rarest token to the rule; a URL
looks its tokens up in the index and the rules found are checked whole.

Tokens that occur in the same URLs only (a host's two parts, say) say the same: one of them is mined for
all, so that what always goes together makes no combinations. A URL of k such tokens supports 2 ** k combinations, and all URLs
at most the sum of these over the support in frequent ones. Where that is at most COMBINATIONS, FP-growth lists them all. Beyond (dozens of keys that
come and go in nearly all URLs, say) the rules are searched: combinations grow by one token at a time, those tokens first that tell most of the
labels, with the URLs that have them (as in FP-growth, only the tokens that may still come), and one is left only where none that it can grow to
is as confident as a rule has to be, or as a rule is that it has already. So all tokens of each URL are mined together in any case, and verdicts
are those of all combinations; the search may still take exponential time, where chance comes near to rules. A rule's confidence has to hold at the lower end of its
95 % interval, so that few URLs prove a rule only if they agree, at any size of table. Tokens below the
support are in no rule. The number of frequent tokens, and with it the index, is bounded by the tokens of
a URL over the support, whatever the number of URLs; it is a constant of the plan, and URLs need no shuffle.
"""

from __future__ import annotations

import json
import math
from itertools import combinations
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK, ALLOW = "block", "allow"
#: Frequent combinations up to which all are listed; beyond, rules are searched.
COMBINATIONS = 1 << 18
#: The normal quantile of the interval of a confidence.
Z = 1.645


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def parsed(pages: DataFrame, url: str = "url") -> DataFrame:
    """row (the columns of ``pages``), host, path and query: host from the first ``://`` up to ``/``,
    ``?``, ``#`` or the end, A-Z in lower case; path from there up to ``?``, ``#`` or the end. Null and
    URLs without ``://`` give empty strings."""
    u = F.coalesce(F.col(url), F.lit(""))
    rest = F.when(F.instr(u, "://") > 0, F.substring(u, F.instr(u, "://") + 3, F.length(u))).otherwise(F.lit(""))
    p = pages.select(F.struct("*").alias("row"), rest.alias("rest"))
    return p.select(
        "row",
        F.translate(F.regexp_extract("rest", r"^([^/?#]*)", 1), UPPER, LOWER).alias("host"),
        F.regexp_extract("rest", r"^[^/?#]*([^?#]*)", 1).alias("path"),
        F.regexp_extract("rest", r"^[^?#]*\?([^#]*)", 1).alias("query"),
    )


def fitting(rules: list[Rule]) -> Column:
    """The longest rule that fits host and path, as a struct (rule, verdict); null if none does.
    A rule fits its host and all subdomains if the path starts with its path."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def tokens() -> Column:
    """The distinct tokens of host, path and query."""
    some = lambda c: F.filter(c, lambda x: x != "")
    named = lambda kind, c: F.transform(c, lambda x: F.concat(F.lit(kind), x))
    names = named("h:", some(F.split("host", r"[.]")))
    dirs = named("p:", F.transform(some(F.split("path", "/")), lambda x: F.regexp_replace(x, "[0-9]+", "0")))
    kind = F.array(F.concat(F.lit("e:"), F.regexp_extract("path", r"(/|[.][a-z0-9]{1,5})$", 1)))
    keys = named("q:", F.transform(some(F.split("query", "&")), lambda x: F.split_part(x, F.lit("="), F.lit(1))))
    return F.array_distinct(F.when(F.col("host") == "", F.array().cast("array<string>")).otherwise(F.concat(names, dirs, kind, keys)))


def _frequent(marked: DataFrame, least: int) -> list[dict]:
    """The tokens of ``least`` URLs or more: token, n, first (of those in the same URLs) and its place
    among all by what it tells of the labels. Sets of URLs are compared by their size and the sums of two hashes."""
    both = [F.xxhash64("tokens", F.monotonically_increasing_id()).alias("a"), F.explode("tokens").alias("token"), "label"]
    count = [F.count_if(F.col("label") == v).alias(v) for v in (BLOCK, ALLOW)]
    sums = marked.select(*both).groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("a").cast("decimal(20,0)")).alias("sum"), F.sum(F.xxhash64("a").cast("decimal(20,0)")).alias("mixed"), *count)
    same = sums.where(F.col("n") >= least).groupBy("n", "sum", "mixed", BLOCK, ALLOW).agg(F.min("token").alias("first"), F.collect_list("token").alias("all")).collect()
    total = marked.agg(F.count(F.lit(1)).alias("n"), *count).first()
    told = lambda r: max(abs(r[v] - r["n"] * total[v] / max(1, total["n"])) for v in (BLOCK, ALLOW))
    order = sorted(same, key=lambda r: (-round(told(r), 6), r["first"]))
    return [{"token": t, "n": r["n"], "first": r["first"], "place": k} for k, r in enumerate(order) for t in r["all"]]


def sure(confidence: Column, n: Column) -> Column:
    """The lower end of a confidence that n cases showed (Wilson's interval)."""
    return (confidence + Z * Z / (2 * n) - Z * F.sqrt(confidence * (1 - confidence) / n + Z * Z / (4 * n * n))) / (1 + Z * Z / n)


def _searched(sets: DataFrame, names: list[str], size: int, least: int, min_confidence: float, min_lift: float) -> list[dict]:
    """The rules among all combinations of the tokens of ``sets`` (rest: ascending places in ``names``; n, block and allow: URLs) but those
    that a rule of their first tokens makes needless: dicts of antecedent, verdict, confidence and support.

    A combination is a node; its URLs are kept by the tokens that may still come (rest), those that leave its label enough URLs.
    Whatever it grows to has c URLs of a label and q others. The confidence is ``top`` at least if c - q * top / (1 - top) is not
    negative. URLs that have all tokens that may come stay; others go with any of the tokens that they lack. So each such token brings at
    most what its own URLs (dealt to one of the tokens they lack) are worth, others counting only where nothing else takes them away."""
    kinds, sums = (BLOCK, ALLOW), [F.sum(c).alias(c) for c in ("n", BLOCK, ALLOW)]
    total = sets.agg(*sums).first()
    lift = {v: min_lift * (total[v] or 0) / size for v in kinds}
    state = [f"{x}_{v}" for v in kinds for x in ("open", "top")]
    start = {f"open_{v}": F.lit(lift[v] <= 1) for v in kinds} | {f"top_{v}": F.lit(float(max(min_confidence, lift[v]))) for v in kinds}
    at = stored(sets.select(F.array().cast("array<int>").alias("ants"), "rest", "n", *kinds).withColumns(start), "cover")
    rules = []
    while not at.isEmpty():
        whole = at.groupBy("ants", *state).agg(*sums)
        grown = at.select("ants", F.explode("rest").alias("t"), "n", *kinds).groupBy("ants", "t").agg(*sums)
        # a token in all URLs of a combination changes nothing
        grown = grown.join(whole.select("ants", F.col("n").alias("whole")), "ants").where("n < whole")
        more = grown.groupBy("ants").agg(*[F.collect_list(F.when(F.col(v) >= least, F.col("t"))).alias(f"more_{v}") for v in kinds])
        node = whole.join(more, "ants", "left")
        for v in kinds:
            confidence = F.col(v) / F.col("n")
            is_rule = F.col(f"open_{v}") & (F.size("ants") > 0) & (F.col(v) >= least) & (confidence >= min_confidence) & (confidence >= lift[v]) & (sure(confidence, F.col("n")) >= min_confidence)
            node = node.withColumns({f"rule_{v}": is_rule, f"more_{v}": F.array_sort(F.coalesce(f"more_{v}", F.array().cast("array<int>")))})
            node = node.withColumns({f"top_{v}": F.greatest(f"top_{v}", F.when(F.col(f"rule_{v}"), confidence)), f"open_{v}": F.col(f"open_{v}") & (F.col(v) < F.col("n")) & (F.size(f"more_{v}") > 0)})
        node = stored(node, "nodes")
        for r in node.where(f"rule_{BLOCK} OR rule_{ALLOW}").collect():
            rules += [{"antecedent": [names[t] for t in r["ants"]], "verdict": v, "confidence": r[v] / r["n"], "support": r[v] / size} for v in kinds if r[f"rule_{v}"]]
        both = at.select("ants", "rest", "n", *kinds).join(node.where(f"open_{BLOCK} OR open_{ALLOW}").drop("n", *kinds), "ants")
        case = [F.struct(F.lit(v).alias("v"), F.array_except(f"more_{v}", "rest").alias("lacks"), F.col(v).alias("c"), (F.col("n") - F.col(v)).alias("q"), F.col(f"top_{v}").alias("top"), F.col(f"open_{v}").alias("open")) for v in kinds]
        split = both.select("ants", F.explode(F.array(*case)).alias("x")).select("ants", "x.*").where("open")
        dealt = split.groupBy("ants", "v", "top", F.get("lacks", F.lit(0)).alias("lacked")).agg(F.sum("c").alias("c"), F.sum(F.when(F.size("lacks") <= 1, F.col("q")).otherwise(0)).alias("q"))
        worth = F.col("c") - F.col("q") * F.col("top") / F.greatest(1 - F.col("top"), F.lit(1e-12))
        bound = dealt.groupBy("ants", "v").agg(F.sum(F.when(F.col("lacked").isNull(), worth).otherwise(F.greatest(worth, F.lit(0.0)))).alias("most")).where("most >= -0.001")
        left = bound.groupBy("ants").agg(*[F.max(F.col("v") == v).alias(f"still_{v}") for v in kinds])
        live = both.join(left, "ants")
        coming = {v: F.when(F.col(f"still_{v}"), F.col(f"more_{v}")).otherwise(F.array().cast("array<int>")) for v in kinds}
        live = live.withColumns({f"more_{v}": coming[v] for v in kinds}).withColumn("rest", F.array_intersect("rest", F.array_union(*[f"more_{v}" for v in kinds])))
        child = live.select("*", F.posexplode("rest").alias("i", "t")).select(
            F.array_append("ants", F.col("t")).alias("ants"), F.slice("rest", F.col("i") + 2, F.size("rest")).alias("rest"), "n", *kinds,
            *[F.array_contains(f"more_{v}", F.col("t")).alias(f"open_{v}") for v in kinds], *[f"top_{v}" for v in kinds],
        )
        new = stored(child.groupBy("ants", "rest", *state).agg(*sums).select("ants", "rest", "n", *kinds, *state), "cover")
        discard(at, node)
        at = new
    discard(at)
    return rules


def mine(labelled: DataFrame, min_support: float = 0.005, min_confidence: float = 0.8, min_lift: float = 1.2, partitions: int | None = None) -> list[dict]:
    """Rules from ``labelled`` (tokens, label or null): dicts of ants, verdict, confidence and support.
    A rule has to hold for the share ``min_support`` of the URLs, and its confidence has to be ``min_confidence`` for sure. An
    empty table gives none. Ties of the pruning go to the shorter rule, then by tokens."""
    marked = stored(labelled.where(F.size("tokens") > 0).select("tokens", "label"), "labelled")
    size = marked.count()
    # no fewer URLs can prove a rule
    proof = math.ceil(Z * Z * min_confidence / (1 - min_confidence)) if min_confidence < 1 else size + 1
    least = max(math.ceil(min_support * size), proof)
    first = _frequent(marked, least) if size >= least else []
    if not first:
        discard(marked)
        return []
    table = F.from_json(F.lit(json.dumps({t["token"]: {"place": t["place"], "first": t["first"]} for t in first}, sort_keys=True)), "map<string,struct<place:int,first:string>>")
    known = F.array_sort(F.array_distinct(F.array_compact(F.transform("tokens", lambda t: F.try_element_at(table, t)))))
    most = marked.agg(F.sum(F.pow(F.lit(2.0), F.size(known)))).first()[0] / least
    if most <= COMBINATIONS:
        items = F.transform(known, lambda x: x["first"])
        held = stored(marked.select(F.when(F.col("label").isNull(), items).otherwise(F.array_append(items, F.concat(F.lit("label:"), "label"))).alias("items")), "items")
        growth = FPGrowth(itemsCol="items", minSupport=least / size, minConfidence=min_confidence, numPartitions=partitions or int(labelled.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        aim = F.col("consequent")[0]
        found = growth.fit(held).associationRules.where(aim.startswith("label:") & (F.col("lift") >= min_lift) & ~F.exists("antecedent", lambda x: x.startswith("label:")))
        found = found.where(sure(F.col("confidence"), F.col("support") * size / F.col("confidence")) >= min_confidence)
        rules = found.select("antecedent", F.substr(aim, F.lit(7)).alias("verdict"), "confidence", "support").collect()
    else:
        counts = [F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("label") == v).alias(v) for v in (BLOCK, ALLOW)]]
        held = stored(marked.groupBy(F.transform(known, lambda x: x["place"]).alias("rest")).agg(*counts), "sets")
        names = [x for _, x in sorted({(t["place"], t["first"]) for t in first})]
        rules = _searched(held, names, size, least, min_confidence, min_lift)
    single = {t["first"]: t["n"] for t in first}
    discard(marked, held)
    got = [{"ants": sorted(r["antecedent"], key=lambda x: (single[x], x)), "verdict": r["verdict"], "confidence": r["confidence"], "support": r["support"]} for r in rules]
    kept: dict[tuple, dict] = {}
    for r in sorted(got, key=lambda r: (len(r["ants"]), r["ants"])):
        ants = sorted(r["ants"])
        if 1 << len(ants) <= len(kept):
            shorter = (kept.get((some, r["verdict"])) for n in range(1, len(ants)) for some in combinations(ants, n))
        else:
            shorter = (k for (some, verdict), k in kept.items() if verdict == r["verdict"] and set(some) < set(ants))
        if not any(k and k["confidence"] >= r["confidence"] for k in shorter):
            kept[tuple(ants), r["verdict"]] = r
    return list(kept.values())


def matched(rules: list[dict]) -> Column:
    """The verdict of the most confident rule whose tokens are all among ``tokens``; null if no
    rule fits; a tie goes to allow."""
    index: dict[str, list[dict]] = {}
    for r in rules:
        index.setdefault(r["ants"][0], []).append({"ants": r["ants"], "verdict": r["verdict"], "confidence": r["confidence"]})
    kind = "map<string,array<struct<ants:array<string>,verdict:string,confidence:double>>>"
    table = F.from_json(F.lit(json.dumps(index, sort_keys=True)), kind)
    listed = F.flatten(F.filter(F.transform("tokens", lambda t: F.try_element_at(table, t)), lambda x: x.isNotNull()))
    whole = F.filter(listed, lambda r: F.forall(r["ants"], lambda a: F.array_contains(F.col("tokens"), a)))
    best = lambda v: F.coalesce(F.array_max(F.transform(F.filter(whole, lambda r: r["verdict"] == v), lambda r: r["confidence"])), F.lit(0.0))
    return F.when(F.size(whole) > 0, F.when(best(BLOCK) > best(ALLOW), F.lit(BLOCK)).otherwise(F.lit(ALLOW)))


def judge(pages: DataFrame, rules: list[Rule], labels: DataFrame | None = None, url: str = "url", page_id: str = "page_id", **mining: float) -> DataFrame:
    """``pages`` with host, path, rule and verdict in place of columns of these names.

    A given rule decides where one fits. Elsewhere the mined rules do, and where none of them fits
    the URL is allowed. The labels to learn from are the given rules' own verdicts and, for other
    URLs, those of ``labels`` (page_id, label), if there are any; they have to be of these URLs. Null
    URLs are allowed; repeated rows are judged alike; an empty table gives no rows."""
    own = ["host", "path", "rule", "verdict"]
    p = parsed(pages, url).withColumns({"fit": fitting(rules), "tokens": tokens()})
    known = p.select("tokens", F.col("fit.verdict").alias("label"), F.col("row")[page_id].alias("id"))
    if labels is not None:
        given = labels.select(F.col("page_id").alias("id"), F.col("label").alias("given")).where(F.col("given").isNotNull()).dropDuplicates(["id"])
        known = known.join(given, "id", "left").withColumn("label", F.coalesce("label", "given"))
    learned = mine(known.select("tokens", "label"), **mining)
    verdict = F.coalesce(F.col("fit.verdict"), matched(learned) if learned else F.lit(None).cast("string"), F.lit(ALLOW))
    out = p.withColumns({"rule": F.col("fit.rule"), "verdict": verdict})
    return out.select(*[F.col("row")[c].alias(c) for c in pages.columns if c not in own], *own)
