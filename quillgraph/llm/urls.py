"""URL filters (native): rules by host and path, and gradient-boosted trees on lexical features.

Everything runs as SQL expressions and aggregations. A tree level is one aggregation of gradients by
(leaf, feature, bin); the driver sees only those sums, of which there are at most
2 ** (depth - 1) * features * 65. The trees become one CASE expression each.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, read

UPPER, LOWERED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (verdict, host, path) of the production query.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
SUFFIXES = ("s_tld", "s_domain", "s_ext")
UNIT = 1 << 20
#: Parts of the training URLs; a URL's suffix shares come from the other parts.
FOLDS = 5


def split_url(url: str) -> dict:
    """Host, path and query as columns; null or no :// gives three empty strings."""
    rest = f"CASE WHEN instr({url}, '://') > 0 THEN substring({url}, instr({url}, '://') + 3) ELSE '' END"
    return {
        "host": F.expr(f"translate(regexp_extract({rest}, '^[^/?#]*', 0), '{UPPER}', '{LOWERED}')"),
        "path": F.expr(f"regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1)"),
        "query": F.expr(f"regexp_extract({rest}, '^[^?#]*[?]([^#]*)', 1)"),
    }


def rule_of(rules) -> tuple:
    """The longest rule that fits and its verdict, both null where none fits. Ties of length go to the smaller rule."""
    name = verdict = F.lit(None).cast("string")
    for what, host, path in sorted(rules, key=lambda r: (len(r[1] + r[2]), [-ord(c) for c in r[1] + r[2]])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        name = F.when(fits, F.lit(host + path)).otherwise(name)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def lexical(u: str = "u") -> dict[str, str]:
    """Lexical features as small integers (SQL over u, host, path, query)."""
    n = f"greatest(length({u}), 1)"
    digits = "length(translate({0}, '0123456789', '')) "
    chars = f"filter(array_distinct(split({u}, '')), c -> c <> '')"
    counts = f"filter(transform({chars}, c -> length({u}) - length(replace({u}, c, ''))), x -> x > 0)"
    return {
        "f_length": f"least(length({u}) div 4, 63)",
        "f_host": "least(length(host), 63)",
        "f_path": "least(length(path) div 2, 63)",
        "f_depth": "least(length(path) - length(replace(path, '/', '')), 63)",
        "f_digits": f"(length({u}) - {digits.format(u)}) * 63 div {n}",
        "f_host_digits": f"least(length(host) - {digits.format('host')}, 63)",
        "f_hyphens": "least(length(host) - length(replace(host, '-', '')), 63)",
        "f_dots": "least(length(host) - length(replace(host, '.', '')), 63)",
        "f_entropy": f"least(int(8 * aggregate({counts}, 0D, (a, x) -> a - x / {n} * log2(x / {n}))), 63)",
        "f_params": "least(if(query = '', 0, 1) + length(query) - length(replace(query, '&', '')), 63)",
        "f_query": "least(length(query) div 2, 63)",
        "f_secure": f"int(startswith({u}, 'https'))",
    }


def suffixes() -> dict[str, str]:
    return {
        "s_tld": "substring_index(host, '.', -1)",
        "s_domain": "substring_index(host, '.', -2)",
        "s_ext": "regexp_extract(path, '[.]([A-Za-z0-9]{1,8})$', 1)",
    }


def boost(train: DataFrame, features: list[str], rounds: int, depth: int, rate: float) -> tuple[float, list[str]]:
    """train: a row per distinct feature vector with n and n_pos. Returns the prior margin and a CASE per tree.

    Gradients are summed as integers of 2 ** -20, so that the order of summing changes nothing.
    """
    n, pos = train.agg(F.sum("n"), F.sum("n_pos")).first()
    prior = math.log((pos + 0.5) / (n - pos + 0.5))
    trees: list[str] = []
    pairs = ", ".join(f"struct({i} AS f, int({f}) AS b)" for i, f in enumerate(features))
    for _ in range(rounds):
        margin = " + ".join([f"double({prior!r})", *trees])
        rows = train.selectExpr("n", "n_pos", *features, f"1 / (1 + exp(-({margin}))) AS p").selectExpr(
            *features, f"bigint(round((n_pos - n * p) * {UNIT})) AS g", f"bigint(round(n * p * (1 - p) * {UNIT})) AS h"
        )
        # A node: the conditions that lead to it, and its sums; None as value while it may be split
        leaves: list[tuple[list[str], int, int]] = [([], None, None)]
        done: list[tuple[list[str], int, int]] = []
        for level in range(depth + 1):
            if not leaves:
                break
            number = "CASE " + " ".join(f"WHEN {' AND '.join(c) or 'true'} THEN {i}" for i, (c, _, _) in enumerate(leaves)) + " END"
            sums = (
                rows.selectExpr(f"{number} AS leaf", f"explode(array({pairs})) AS x", "g", "h")
                .where("leaf IS NOT NULL")
                .groupBy("leaf", "x.f", "x.b")
                .agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
                .collect()
                if level < depth
                else []
            )
            if level == depth:
                done += leaves
                break
            following = []
            for i, (conditions, g_known, h_known) in enumerate(leaves):
                own = [r for r in sums if r.leaf == i]
                g_all, h_all = sum(r.g for r in own if r.f == 0), sum(r.h for r in own if r.f == 0)
                best = (0.0, None)
                for f in range(len(features)):
                    g = h = 0
                    bins = sorted((r.b, r.g, r.h) for r in own if r.f == f)
                    for (b, bg, bh), _ in zip(bins, bins[1:], strict=False):
                        g, h = g + bg, h + bh
                        gain = sum((a / UNIT) ** 2 / (c / UNIT + 1.0) for a, c in ((g, h), (g_all - g, h_all - h))) - (g_all / UNIT) ** 2 / (h_all / UNIT + 1.0)
                        if gain > best[0] + 1e-9:
                            best = (gain, (f, b, g, h))
                if best[1] is None or best[0] < 0.5:
                    done.append((conditions, g_all, h_all))
                    continue
                f, b, g, h = best[1]
                following.append((conditions + [f"{features[f]} <= {b}"], g, h))
                following.append((conditions + [f"{features[f]} > {b}"], g_all - g, h_all - h))
            leaves = following
        cases = [f"WHEN {' AND '.join(c) or 'true'} THEN {round(rate * (g / UNIT) / (h / UNIT + 1.0), 6)}D" for c, g, h in done]
        trees.append("(CASE " + " ".join(cases) + " ELSE 0D END)")
        if len(done) == 1:
            break
    return prior, trees


def judge(
    pages: DataFrame,
    rules=RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    rounds: int = 8,
    depth: int = 3,
    rate: float = 0.5,
    max_training_rows: int = 200_000,
) -> DataFrame:
    """A verdict for every URL: its rule's, else that of boosted trees.

    The trees learn from URLs that a rule labels (block is 1), or from a hash sample of about
    `max_training_rows` of them where there are more. Their features are length, depth, digit ratio,
    entropy, parameter counts and, for the top-level domain, domain and file extension, the smoothed share
    of blocked URLs among labelled ones (for a training URL among those of other folds). The suffix table has at most three rows
    per training row. Very long URLs are read whole; of splits that tie the first feature and bin win; a margin of 0 allows.
    Defined results: a null URL or one without :// has empty host and path, no rule, and the trees'
    verdict; with no labelled URL all others are allowed; with labels of one kind that kind is the verdict.
    Repeated rows are judged alike. Columns other than the two named ones are ignored. An empty table gives
    no rows.
    """
    spark = pages.sparkSession
    base = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("raw"))
    parts = split_url("raw")
    name, verdict = rule_of(rules)
    base = base.select("page_id", F.coalesce("raw", F.lit("")).alias("u"), *[c.alias(k) for k, c in parts.items()])
    base = base.select("page_id", "u", *[F.coalesce(k, F.lit("")).alias(k) for k in parts])
    base = base.withColumns({"rule": name, "ruled": verdict})
    labelled = base.where("rule IS NOT NULL")
    n, blocked = labelled.agg(F.count("*"), F.sum(F.expr("int(ruled = 'block')"))).first()
    out = ["page_id", "host", "path", "rule"]
    if not n or blocked in (0, n):
        kind = "block" if n and blocked == n else "allow"
        return base.select(*out, F.coalesce("ruled", F.lit(kind)).alias("verdict"))
    scratch = Scratch(spark)
    if n > max_training_rows:
        labelled = labelled.where(F.expr(f"pmod(xxhash64(u), {UNIT}) < {int(UNIT * max_training_rows / n) + 1}"))
    lex, suf = lexical(), suffixes()
    fold = f"int(pmod(xxhash64(u, 17), {FOLDS})) AS fold"
    train = scratch.table(labelled.selectExpr("int(ruled = 'block') AS y", fold, *[f"{e} AS {k}" for k, e in lex.items()], *[f"{e} AS {k}" for k, e in suf.items()]))
    share = blocked / n
    smoothed = f"int(63 * ({{0}} + 8 * double({share!r})) / ({{1}} + 8))"
    by_fold = reduce(
        DataFrame.unionByName,
        [train.groupBy(F.lit(k).alias("kind"), F.col(k).alias("value"), "fold").agg(F.count("*").alias("n"), F.sum("y").alias("pos")) for k in suf],
    )
    by_fold = scratch.table(by_fold)
    total = by_fold.groupBy("kind", "value").agg(F.sum("n").alias("all_n"), F.sum("pos").alias("all_pos"))
    stats = scratch.table(total.selectExpr("kind", "value", smoothed.format("all_pos", "all_n") + " AS share"))
    # The trees learn from shares without a URL's own fold, so that no label is told by itself
    others = scratch.table(by_fold.join(total, ["kind", "value"]).selectExpr("kind", "value", "fold", smoothed.format("(all_pos - pos)", "(all_n - n)") + " AS share"))
    features = [*lex, *[f"r{k}" for k in suf]]

    def with_shares(df: DataFrame, table: DataFrame, *on: str) -> DataFrame:
        for k in suf:
            own = table.where(F.col("kind") == k).select(F.col("value").alias(k), *on, F.col("share").alias(f"r{k}"))
            df = df.join(F.broadcast(own), [k, *on], "left").fillna({f"r{k}": int(63 * share)})
        return df

    grouped = scratch.table(with_shares(train, others, "fold").groupBy(*features).agg(F.count("*").alias("n"), F.sum("y").alias("n_pos")))
    prior, trees = boost(grouped, features, rounds, depth, rate)
    scratch.drop(train, grouped, by_fold, others)
    margin = " + ".join([f"double({prior!r})", *trees])
    scored = with_shares(base.selectExpr("page_id", "host", "path", "rule", "ruled", *[f"{e} AS {k}" for k, e in lex.items()], *[f"{e} AS {k}" for k, e in suf.items()]), stats)
    return scored.select(
        *out,
        F.expr(f"coalesce(ruled, CASE WHEN {margin} > 0 THEN 'block' ELSE 'allow' END)").alias("verdict"),
        F.expr(f"1 / (1 + exp(-({margin})))").alias("block_score"),
    )


def op9_url_filters(spark, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "pages"))
