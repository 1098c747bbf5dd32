"""Secret scans over a ledger of content-addressed texts.

Every version of every text is addressed by its SHA-256. A text is scanned once for each rule and
rule version, however many paths or earlier runs hold it; what was found joins back to all paths.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEDGER = "blob string, rule string, rule_version int, spans array<struct<start:int,end:int>>"
NO_SPANS = "array<struct<start:int,end:int>>"


@dataclass(frozen=True)
class Rule:
    """A pattern for Java's regular expressions; ``group`` must have ``least`` characters."""

    name: str
    pattern: str
    version: int = 1
    group: int = 0
    least: int = 1


# Fixed values. Runs of one character class are asked for at their full length at once: a match
# starts where its run starts, so a shorter run fails either way.
RULES = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}+"),
    Rule("hex", r"[0-9a-f]{24,}+"),
)


def match_spans(text: Column, rule: Rule) -> Column:
    """Start and end, in code points, of the leftmost non-overlapping matches that are long enough.

    The pieces between matches and the matches themselves alternate; their lengths, added up,
    are the positions.
    """
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    held = matches if rule.group == 0 else F.regexp_extract_all(text, pattern, F.lit(rule.group))
    runs = F.arrays_zip(
        F.transform(F.slice(F.split(text, rule.pattern, -1), F.lit(1), F.size(matches)), F.length).alias("gap"),
        F.transform(matches, F.length).alias("size"),
        F.transform(held, lambda g: F.length(g) >= rule.least).alias("fits"),
    )

    def step(acc: Column, run: Column) -> Column:
        start = acc["at"] + run["gap"]
        span = F.struct(start.alias("start"), (start + run["size"]).alias("end"))
        spans = F.when(run["fits"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct((start + run["size"]).alias("at"), spans.alias("spans"))

    begin = F.struct(F.lit(0).alias("at"), F.array().cast(NO_SPANS).alias("spans"))
    found = F.aggregate(runs, begin, step, lambda acc: acc["spans"])
    return F.when(F.regexp_like(text, pattern), found).otherwise(F.array().cast(NO_SPANS))


def address(versions: DataFrame) -> DataFrame:
    """``path, blob, text`` of ``doc_id, text``; a null text is the empty one."""
    text = F.coalesce(versions["text"], F.lit(""))
    return versions.select(versions["doc_id"].alias("path"), F.sha2(text, 256).alias("blob"), text.alias("text"))


def scan_unseen(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan the texts that the ledger does not have for a rule's version; returns new ledger rows.

    One row per (blob, rule, version) that was scanned, with its spans, empty ones too: they say
    that the pair has been seen. Append the result to the ledger's table.
    """
    blobs = address(versions).select("blob", "text").dropDuplicates(["blob"])
    wanted = [F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("rule_version")) for r in rules]
    if ledger is None:
        blobs = blobs.withColumn("seen", F.array().cast("array<struct<rule:string,rule_version:int>>"))
    else:
        pair = F.struct("rule", "rule_version")
        seen = ledger.where(pair.isin(wanted)).groupBy("blob").agg(F.collect_set(pair).alias("seen"))
        blobs = blobs.join(seen, "blob", "left")
        blobs = blobs.where(F.size(F.array_except(F.array(*wanted), F.coalesce("seen", F.array()))) > 0)
    scans = [
        F.when(
            F.coalesce(F.array_contains("seen", pair), F.lit(False)),
            F.lit(None),
        ).otherwise(
            F.struct(
                F.lit(r.name).alias("rule"),
                F.lit(r.version).alias("rule_version"),
                match_spans(F.col("text"), r).alias("spans"),
            )
        )
        for r, pair in zip(rules, wanted, strict=True)
    ]
    rows = blobs.select("blob", F.explode(F.filter(F.array(*scans), lambda s: s.isNotNull())).alias("row"))
    return rows.select("blob", "row.rule", "row.rule_version", "row.spans")


def findings(versions: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All spans of every path: ``path, spans``, spans an array of ``start, rule_no, end`` in order.

    Paths with equal texts share one ledger entry. A path without findings has an empty array.
    Repeated paths give a row each; null paths are paths like others.
    """
    number = F.array_position(F.array(*[F.lit(r.name) for r in rules]), F.col("rule")).cast("int")
    current = F.struct("rule", "rule_version").isin(
        [F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("rule_version")) for r in rules]
    )
    hits = (
        ledger.where(current & (F.size("spans") > 0))
        .select("blob", number.alias("rule_no"), F.explode("spans").alias("span"))
        .groupBy("blob")
        .agg(F.array_sort(F.collect_set(F.struct("span.start", "rule_no", "span.end"))).alias("spans"))
    )
    empty = F.array().cast("array<struct<start:int,rule_no:int,end:int>>")
    return (
        address(versions)
        .select("path", "blob")
        .join(hits, "blob", "left")
        .select("path", F.coalesce("spans", empty).alias("spans"))
    )


def span_text(spans: Column, kinds: list[str]) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["rule_no"]), s["start"], s["end"])), ","
    )


def _count_of(number: int) -> Column:
    return F.size(F.filter("spans", lambda s: s["rule_no"] == number)).cast("long")


def secret_report(docs: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """Count and digest the secrets of each document: ``doc_id``, a count per rule, ``base_sha256, spans``.

    Null and empty texts have no secrets; repeated rows give repeated rows; an empty table gives none.
    """
    fresh = scan_unseen(docs, ledger)
    known = fresh if ledger is None else ledger.select(*fresh.columns).unionByName(fresh)
    found = findings(docs, known)
    kinds = [r.name for r in RULES]
    counts = [_count_of(n).alias(f"n_{kind}") for n, kind in enumerate(kinds, 1)]
    text = span_text(F.col("spans"), kinds)
    return found.select(F.col("path").alias("doc_id"), *counts, F.sha2(text, 256).alias("base_sha256"), text.alias("spans"))
