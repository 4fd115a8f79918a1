"""Company network: name rules, relation edges, iterative expansion, ranking, provinces.

Iterative jobs keep their state in written tables: each pass reads the last one, so
neither the plan nor the lineage grows with the number of passes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.functions import fixed_values as V
from webloom.functions.text import normalise_region
from webloom.session import GrowingTable, cut_bucketed, cut_lineage


# --- name rules --------------------------------------------------------------


@dataclass(frozen=True)
class CompanyRules:
    """Patterns of the company-name cascade; the defaults are the fixed values."""

    min_length: int = 4
    credit: str = V.COMPANY_CREDIT
    credit_keep: str = V.COMPANY_CREDIT_KEEP
    shop_end: str = V.COMPANY_SHOP_END
    shop_keep: str = V.COMPANY_SHOP_KEEP
    animals: str = V.COMPANY_ANIMALS
    hospital_end: str = V.COMPANY_HOSPITAL_END
    industry: str = V.COMPANY_INDUSTRY
    services: str = V.COMPANY_SERVICES
    hospital_word: str = "医院"
    investor: Sequence[str] = field(default_factory=lambda: V.MEDICAL_INVESTOR)
    hospital: Sequence[str] = field(default_factory=lambda: V.HOSPITAL_NAME)
    clinic: str = V.CLINIC_NAME
    labels: Sequence[str] = field(default_factory=lambda: V.COMPANY_LABELS)


def _any(c: Column, patterns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.rlike(c, F.lit(p)) for p in patterns])


def classify_company(c: Column, rules: CompanyRules | None = None) -> Column:
    """Medical label of a company name, '' when rejected or unknown; first rule wins."""
    r = rules or CompanyRules()
    hit = lambda p: F.rlike(c, F.lit(p))
    rejected = (
        F.when(F.length(c) < r.min_length, True)
        .when(hit(r.credit) & hit(r.credit_keep), False)
        .when(hit(r.shop_end) & ~hit(r.shop_keep), True)
        .when(hit(r.animals), True)
        .when(~hit(r.hospital_end) & hit(r.industry), True)
        .when(hit(r.services), True)
        .otherwise(False)
    )
    invest, hospital, clinic = r.labels
    return (
        F.when(rejected, "").when(_any(c, r.investor), invest)
        .when(F.contains(c, F.lit(r.hospital_word)) & _any(c, r.hospital), hospital)
        .when(hit(r.clinic), clinic).otherwise("")
    )


def is_medical_label(label: Column, strict: bool = True) -> Column:
    return label.isin(*(V.STRICT_MEDICAL_LABELS if strict else V.COMPANY_LABELS))


def is_investment_company(c: Column) -> Column:
    hit = lambda p: F.rlike(c, F.lit(p))
    return hit(V.INVESTOR_ALWAYS) | (hit(V.INVESTOR_COMPANY[0]) & hit(V.INVESTOR_COMPANY[1])) | (
        hit(V.INVESTOR_GROUP[0]) & hit(V.INVESTOR_GROUP[1])
    )


def classify_agent(c: Column, pattern: str | None = None) -> Column:
    """``person`` for names of up to four characters, else ``company``; with a pattern only
    names that match it are companies."""
    longer = F.lit(True) if pattern is None else F.rlike(c, F.lit(pattern))
    return F.when((F.length(c) > 4) & longer, "company").otherwise("person")


# --- relation edges ----------------------------------------------------------

RELATION_LISTS = ("shareholders", "executives", "branches", "invests")


def related_names(
    companies: DataFrame, include_self: bool = False, skip: Sequence[str] = (), only: Sequence[str] | None = None
) -> DataFrame:
    """Distinct (company, related) edges from the nested lists and the legal person.
    ``skip`` leaves lists out, ``only`` keeps the given ones."""
    lists = [c for c in RELATION_LISTS if c in companies.columns and c not in skip and (only is None or c in only)]
    none = F.array().cast("array<string>")
    parts = [F.coalesce(F.transform(c, lambda x: x["name"]), none) for c in lists]
    if "legal_person" in companies.columns and only is None:
        parts.append(F.array("legal_person"))
    edges = companies.select(F.col("name").alias("company"), F.explode(F.array_distinct(F.concat(*parts))).alias("related"))
    edges = edges.where("related is not null and related <> ''")
    if not include_self:
        edges = edges.where("related <> company")
    else:
        edges = edges.unionByName(companies.select(F.col("name").alias("company"), F.col("name").alias("related")))
    return edges.distinct()


def candidate_companies(
    edges: DataFrame, labels: DataFrame, seeds: DataFrame, min_overlap: int = 3, max_related: int = 500, share: float = 0.1
) -> DataFrame:
    """Companies kept by their label, or by their relations to the seed list.
    ``labels``: company, label ('' for none); ``seeds``: name."""
    marked = edges.join(seeds.select(F.col("name").alias("related"), F.lit(1).alias("_s")), "related", "left")
    counts = marked.groupBy("company").agg(F.count(F.lit(1)).alias("related_cnt"), F.count("_s").alias("overlap"))
    rows = labels.join(counts, "company", "left").select(
        "company", "label", F.coalesce("related_cnt", F.lit(0)).alias("related_cnt"), F.coalesce("overlap", F.lit(0)).alias("overlap")
    )
    linked = (
        (F.col("overlap") >= min_overlap) & (F.col("related_cnt") < max_related) & (F.col("overlap") > F.col("related_cnt") * share)
    )
    why = F.when(F.col("label") != "", "label").when(linked, "related")
    return rows.withColumn("why", why).where("why is not null")


def _usable(edges: DataFrame, controllers: DataFrame | None, most: int) -> DataFrame:
    """(company, related, size) of the companies with at most ``most`` relations in ``controllers``; size counts all relations."""
    sizes = edges.groupBy("company").agg(F.count(F.lit(1)).alias("size"))
    counted = edges if controllers is None else controllers
    big = counted.groupBy("company").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most).select("company")
    return edges.join(sizes, "company").join(big, "company", "left_anti")


def expand_co_impact(
    seeds: DataFrame, edges: DataFrame, depth: int = 5, share: float = 0.01, min_companies: int = 2, max_controllers: int = 500,
    controllers: DataFrame | None = None,
) -> DataFrame:
    """Front of agents grown from the seeds: (name, depth, rtype).

    Per pass, a company with a front relation that makes up ``share`` of its relations
    joins, and so does an agent related to ``min_companies`` such companies. Companies
    with more than ``max_controllers`` relations among ``controllers`` (without the companies they invest in; default: all of ``edges``) take no part.
    A name found both as company and as agent has the agent's type. Stops when nothing is new.
    """
    usable = cut_lineage(_usable(edges, controllers, max_controllers), "impact-edges")
    start = seeds.select("name").distinct().select("name", F.lit(0).alias("depth"), F.lit("person").alias("rtype"))
    grown = GrowingTable(start, "impact-front")
    for level in range(1, depth + 1):
        front = grown.all()
        touched = usable.join(front.select(F.col("name").alias("related")), "related", "left_semi")
        active = (
            touched.groupBy("company").agg(F.count(F.lit(1)).alias("_n"), F.first("size").alias("size"))
            .where(F.col("_n") >= F.col("size") * share)
            .select("company")
        )
        agents = (
            usable.join(active, "company", "left_semi").groupBy(F.col("related").alias("name"))
            .agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_companies).select("name")
        )
        found = active.select(F.col("company").alias("name"), F.lit("xcompany").alias("rtype")).unionByName(
            agents.select("name", classify_agent(F.col("name")).alias("rtype"))
        )
        kind = F.min(F.struct((F.col("rtype") == "xcompany").alias("late"), "rtype"))["rtype"].alias("rtype")
        new = found.groupBy("name").agg(kind).join(front, "name", "left_anti").select("name", F.lit(level).alias("depth"), "rtype")
        if grown.add(new).isEmpty():
            break
    return grown.all()


def spread_pass_loose(front: DataFrame, edges: DataFrame, share: float = 0.01) -> DataFrame:
    """Looser pass: every other relation of a touched company outside the front joins."""
    sizes = edges.groupBy("company").agg(F.count(F.lit(1)).alias("_size"))
    names = front.select("name").distinct()
    outside = edges.join(names.select(F.col("name").alias("company")), "company", "left_anti")
    touched = outside.join(names.select(F.col("name").alias("related")), "related", "left_semi")
    active = (
        touched.groupBy("company").agg(F.count(F.lit(1)).alias("_n")).join(sizes, "company")
        .where(F.col("_n") >= F.col("_size") * share).select("company")
    )
    related = outside.join(active, "company", "left_semi").select(F.col("related").alias("name")).distinct()
    return related.join(names, "name", "left_anti")


def _closure(start: DataFrame, edges: DataFrame, limit: int | None) -> DataFrame:
    """(name, depth) of every name reachable over (src, dst) edges, starts at depth 0."""
    edges = cut_lineage(edges.select("src", "dst").distinct(), "closure-edges")
    seen = GrowingTable(start.select("name").distinct().withColumn("depth", F.lit(0)), "closure")
    frontier, level = seen.all(), 0
    while limit is None or level < limit:
        level += 1
        step = frontier.select(F.col("name").alias("src")).join(edges, "src").select(F.col("dst").alias("name")).distinct()
        frontier = seen.add(step.join(seen.all(), "name", "left_anti").withColumn("depth", F.lit(level)))
        if frontier.isEmpty():
            break
    return seen.all()


def reachable(selected: DataFrame, invests: DataFrame, known: DataFrame) -> DataFrame:
    """Known companies in the closure of the selected names over investments. An unknown
    company is not followed."""
    usable = invests.join(known.select(F.col("name").alias("src")), "src", "left_semi")
    return _closure(selected, usable, None).join(known.select("name").distinct(), "name", "left_semi").select("name")


def layered_expand(start: DataFrame, invests: DataFrame, holders: DataFrame, limit: int) -> DataFrame:
    """(name, direction, depth): descendants over investments and ancestors over
    shareholders up to ``limit`` layers, nobody visited twice per direction."""
    down = _closure(start, invests, limit).withColumn("direction", F.lit("down"))
    up = _closure(start, holders, limit).withColumn("direction", F.lit("up"))
    return down.unionByName(up)


def noisy_or_spread(
    seeds: DataFrame, edges: DataFrame, depth: int = 10, damping: float = 0.8, admit: float = 0.5, seed_p: float = 0.9,
    min_related: int = 2, share: float = 0.01, max_controllers: int = 500, controllers: DataFrame | None = None,
) -> DataFrame:
    """(name, depth, p): probability spread over undirected (company, related) edges.

    A name with at least ``min_related`` relations, ``share`` of them in the front, gets
    damping * (1 - product of (1 - p)); it is admitted at ``admit`` and keeps that value. A pass joins the links, which are laid out
    once by neighbour, with the names admitted in the pass before only, and adds what they bring to sums kept per name.
    """
    used = _usable(edges, controllers, max_controllers)
    both = used.select(F.col("company").alias("a"), F.col("related").alias("b")).unionByName(
        used.select(F.col("related").alias("a"), F.col("company").alias("b"))
    ).distinct()
    degree = both.groupBy("a").agg(F.count(F.lit(1)).alias("deg")).where(F.col("deg") >= min_related)
    parts = int(used.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    links = cut_bucketed(both.join(degree, "a"), "spread-links", parts, ["b"])
    grown = GrowingTable(seeds.select("name").distinct().select("name", F.lit(0).alias("depth"), F.lit(seed_p).alias("p")), "spread-front")
    fresh, sums = grown.all(), None
    for level in range(1, depth + 1):
        # ln(1 - p) is summed; a certain neighbour (p = 1) is counted apart, since its log has no value
        sure = F.count_if(F.col("p") >= 1).alias("sure")
        log_rest = F.coalesce(F.sum(F.when(F.col("p") < 1, F.log1p(-F.col("p")))), F.lit(0.0)).alias("log_rest")
        gained = links.join(fresh.select(F.col("name").alias("b"), "p"), "b").groupBy("a").agg(
            F.count(F.lit(1)).alias("n"), F.first("deg").alias("deg"), sure, log_rest
        )
        if sums is None:
            sums = GrowingTable(gained, "spread-sums")
            gained = sums.all()
        else:
            gained = sums.add(gained)
        # only names that gained a neighbour can pass now: what they have so far, and whether that is enough
        so_far = sums.all().join(gained.select("a"), "a", "left_semi").groupBy("a").agg(
            F.sum("n").alias("n"), F.first("deg").alias("deg"), F.sum("sure").alias("sure"), F.sum("log_rest").alias("log_rest")
        )
        p = damping * F.when(F.col("sure") > 0, 1.0).otherwise(1 - F.exp("log_rest"))
        scored = so_far.where(F.col("n") >= F.col("deg") * share).select(F.col("a").alias("name"), p.alias("p"))
        new = scored.where(F.col("p") >= admit).join(grown.all(), "name", "left_anti").select("name", F.lit(level).alias("depth"), "p")
        fresh = grown.add(new)
        if fresh.isEmpty():
            break
    return grown.all()


def hospital_overlap(edges: DataFrame, hospitals: DataFrame, front: DataFrame) -> DataFrame:
    """Number of hospitals with at least one and at least two front relations."""
    counts = (
        edges.join(hospitals.select(F.col("name").alias("company")), "company", "left_semi")
        .join(front.select(F.col("name").alias("related")), "related", "left_semi")
        .groupBy("company").agg(F.count(F.lit(1)).alias("_n"))
    )
    return counts.agg(F.count(F.lit(1)).alias("hospital_1"), F.count(F.when(F.col("_n") >= 2, 1)).alias("hospital_2"))


def agent_report(front: DataFrame, edges: DataFrame) -> DataFrame:
    """(name, rtype, depth, company_cnt, company): the agents of the front, one row per company of the front they are related to
    (null company when there is none)."""
    agents = front.where("rtype <> 'xcompany'")
    used = edges.join(front.where("rtype = 'xcompany'").select(F.col("name").alias("company")), "company", "left_semi")
    pairs = used.select(F.col("related").alias("name"), "company").distinct()
    counts = pairs.groupBy("name").agg(F.count(F.lit(1)).alias("company_cnt"))
    return agents.join(pairs, "name", "left").join(counts, "name", "left").select(
        "name", "rtype", "depth", F.coalesce("company_cnt", F.lit(0)).alias("company_cnt"), "company"
    )


# --- ranking -----------------------------------------------------------------


def pagerank(
    edges: DataFrame, alpha: float = 0.85, iters: int = 1000, tol: float = 1e-6, directed: bool = True,
    weight: str | None = None, personalization: DataFrame | None = None, part_edges: int = 1_000_000, at_once: int = 8,
) -> DataFrame:
    """(name, rank) over (src, dst[, weight]) edges; ranks sum to 1 and differ from the exact ones by at most ``tol`` in sum.

    The rank of vertices without out-edges is handed out like the restart, which only scales the ranks that come from the
    restart alone; so these are worked out and made to sum to 1. Every vertex begins with its restart as residual. ``alpha`` of the
    residuals is handed on along the edges ``at_once`` times, then that combination of the passes is added to the ranks which
    leaves least: the one of least squares, or the plain sum of all passes where that leaves less. The plain sum leaves at most ``alpha`` to
    the power of ``at_once``, so every graph converges; on most the least squares need far fewer passes. More than ``iters`` passes are an
    ArithmeticError. ``personalization``: name, weight, none below 0.
    """
    w = F.col(weight) if weight else F.lit(1.0)
    e = edges.select("src", "dst", w.cast("double").alias("w"))
    if not directed:
        back = e.where("src <> dst").select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w")
        e = e.unionByName(back)
    e = e.groupBy("src", "dst").agg((F.sum("w") if weight else F.max("w")).alias("w"))
    e = cut_lineage(e, "rank-edges")
    # A source with very many edges is split into parts; its rank is handed to each part.
    out = e.groupBy("src").agg(
        F.sum("w").alias("_out"), F.ceil(F.count(F.lit(1)) / part_edges).cast("int").alias("parts")
    ).where("_out > 0")
    out = cut_lineage(out, "rank-out")
    part = F.expr("pmod(xxhash64(dst), parts)").cast("int")
    weighted = e.join(out, "src").select("src", "dst", part.alias("part"), (F.lit(alpha) * F.col("w") / F.col("_out")).alias("w"))
    # The edges are written once, in buckets by (src, part), with the parts of their targets: a pass moves only residuals.
    weighted = weighted.join(out.select(F.col("src").alias("dst"), F.col("parts").alias("parts")), "dst", "left")
    n_parts = int(e.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    links = cut_bucketed(weighted, "rank-links", n_parts, ["src", "part"])
    names = e.select(F.explode(F.array("src", "dst")).alias("name")).distinct()
    if personalization is None:
        base = names.withColumn("r", F.lit(1.0))
    else:
        q = personalization.groupBy("name").agg(F.sum("weight").cast("double").alias("r"))
        base = names.join(q, "name", "left").withColumn("r", F.coalesce("r", F.lit(0.0)))
    base = cut_lineage(base.join(out.select(F.col("src").alias("name"), "parts"), "name", "left"), "rank-base")
    n, whole = base.agg(F.count(F.lit(1)), F.sum("r")).first()
    if not n:
        return base.select("name", F.lit(0.0).alias("rank"))
    if not whole:  # nobody restarts, so nobody has a rank
        return base.select("name", F.lit(None).cast("double").alias("rank"))
    # a residual of this sum hands out at most tol / 2 of all ranks, and making the ranks sum to 1 can double that
    least = tol * (1 - alpha) * whole / 2
    left, gains = base.where("r > 0").select("name", "parts", "r"), []
    for done in range(0, iters, at_once):
        passes = [left]
        turns = min(at_once, iters - done)
        for turn in range(turns):
            # vertices without out-edges have no parts
            handed = passes[-1].where("parts is not null").select(
                F.col("name").alias("src"), "r", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
            )
            # the few residuals are hashed, so the edges need not be sorted
            got = links.join(handed.hint("shuffle_hash"), ["src", "part"]).groupBy(F.col("dst").alias("name")).agg(
                F.max("parts").alias("parts"), F.sum(F.col("r") * F.col("w")).alias("r")
            )
            passes.append(cut_lineage(got, "rank-pass") if turn < turns - 1 else got)  # the last is written with the others
        rows = reduce(DataFrame.unionByName, [p.withColumn("at", F.lit(i)) for i, p in enumerate(passes)])
        each = [F.sum(F.when(F.col("at") == i, F.col("r")).otherwise(0.0)).alias(f"v{i}") for i in range(len(passes))]
        step = cut_lineage(rows.groupBy("name").agg(F.max("parts").alias("parts"), *each), "rank-passes")
        rest, gain, missing = _least_rest(step, len(passes) - 1)
        gains.append(step.select("name", gain.alias("r")))
        if missing <= least:
            break
        left = step.select("name", "parts", rest.alias("r"))
    else:
        raise ArithmeticError(f"ranks have not converged to {tol} in {iters} passes")
    scores = cut_lineage(reduce(DataFrame.unionByName, gains).groupBy("name").agg(F.sum("r").alias("got")), "rank-scores")
    total = scores.agg(F.sum("got")).first()[0]
    # no rank is below the restart; rounding of the combinations may say so
    rank = F.when(F.col("got").isNull(), 0.0).otherwise(F.greatest("r", "got") / total)
    return base.join(scores, "name", "left").select("name", rank.alias("rank"))


def _least_rest(step: DataFrame, m: int) -> tuple[Column, Column, float]:
    """(residual left, ranks gained, sum of the residual's sizes) of the best combination of ``m`` passes: v0 is the residual,
    v1 to vm what it hands on once to ``m`` times. The driver sees their inner products only."""
    v = [F.col(f"v{i}") for i in range(m + 1)]
    pairs = [(i, j) for i in range(m + 1) for j in range(i, m + 1)]
    inner = np.zeros((m + 1, m + 1))
    for (i, j), x in zip(pairs, step.agg(*[F.sum(v[i] * v[j]) for i, j in pairs]).first(), strict=True):
        inner[i, j] = inner[j, i] = x
    # taking y of the passes v0 to v(m-1) leaves v0 - sum of y_i (v_i - v_i+1)
    lost = np.eye(m + 1, m) - np.eye(m + 1, m, -1)
    size = np.sqrt(np.maximum(np.diag(lost.T @ inner @ lost), 1e-300))
    scaled = lost / size
    fitted = np.linalg.lstsq(scaled.T @ inner @ scaled, scaled.T @ inner[:, 0], rcond=1e-13)[0] / size
    combined = lambda c: reduce(lambda x, y: x + y, [F.lit(float(k)) * v[i] for i, k in enumerate(c)])
    choices = []
    for y in (fitted, np.ones(m)):
        choices.append((combined(np.eye(m + 1)[0] - lost @ y), combined(y)))
    sums = step.agg(*[F.sum(F.abs(rest)) for rest, _ in choices]).first()
    best = 0 if sums[0] < sums[1] else 1
    return *choices[best], sums[best]


# --- provinces ---------------------------------------------------------------


def region_aliases(regions: DataFrame) -> DataFrame:
    """(level, alias, province, code) of regions (level, name, province, code): name, its
    normalised and its compact form, with the compact province name."""
    _, province = normalise_region(F.col("province"), "province")
    out = None
    for level in V.REGION_RULES:
        norm, compact = normalise_region(F.col("name"), level)
        part = regions.where(F.col("level") == level).select(
            "level", F.explode(F.array_distinct(F.array("name", norm, compact))).alias("alias"), province.alias("province"), "code"
        ).where(norm != "")
        out = part if out is None else out.unionByName(part)
    return out.where("alias <> ''")


def unambiguous_alias(aliases: DataFrame) -> DataFrame:
    """Aliases all of whose codes lie in one province."""
    return (
        aliases.groupBy("alias").agg(F.count_distinct("province").alias("_n"), F.min("province").alias("province"))
        .where("_n = 1").select("alias", "province")
    )


def guess_province(rows: DataFrame, key: str, addresses: str, aliases: DataFrame) -> DataFrame:
    """Province of the first address that starts with, or brackets, an alias: provinces
    first, then cities, then any unambiguous alias; '' when none fits."""
    def level_table(name: str, rank: int) -> DataFrame:
        return unambiguous_alias(aliases.where(F.col("level") == name)).withColumn("rank", F.lit(rank))

    table = level_table("province", 0).unionByName(level_table("city", 1)).unionByName(
        unambiguous_alias(aliases).withColumn("rank", F.lit(2))
    )
    longest = table.agg(F.max(F.length("alias"))).scalar()
    a = rows.select(key, F.posexplode(addresses).alias("_pos", "_a")).where("_a <> ''")
    a = a.withColumn("_max", F.least(F.length("_a"), longest))
    starts = F.transform(F.sequence(F.lit(1), F.col("_max")), lambda n: F.substring(F.col("_a"), F.lit(1), n))
    bracketed = F.regexp_extract_all("_a", F.lit("（([^（）]+)）"), 1)
    cand = a.select(key, "_pos", F.explode(F.array_distinct(F.concat(starts, bracketed))).alias("alias"))
    best = (
        cand.join(table, "alias").groupBy(key)
        .agg(F.min(F.struct("_pos", "rank", (-F.length("alias")).alias("_l"), "alias", "province")).alias("_b"))
    )
    return rows.select(key).distinct().join(best, key, "left").select(key, F.coalesce("_b.province", F.lit("")).alias("province"))


def seed_stats(seeds: DataFrame, search: DataFrame, big: int = 2000) -> DataFrame:
    """Per seed list: keywords, searched, missing, summed results, and keywords with more
    than ``big`` results. ``seeds``: step, keyword; ``search``: keyword, actual."""
    s = seeds.select("step", "keyword").distinct().join(search.select("keyword", "actual"), "keyword", "left")
    return s.groupBy("step").agg(
        F.count(F.lit(1)).alias("keywords"), F.count("actual").alias("searched"),
        F.count(F.when(F.col("actual").isNull(), 1)).alias("missing"), F.coalesce(F.sum("actual"), F.lit(0)).alias("total_actual"),
        F.count(F.when(F.col("actual") > big, 1)).alias("big"),
    )
