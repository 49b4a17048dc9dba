"""Secret scan with corpus-wide ownership frequency.

One pass over the texts finds the base patterns (``assign``, ``access``, ``hex``)
and bare candidate tokens (long, letters and digits mixed, high entropy).  Only
64-bit hashes of the candidates' values leave it.  Each hash is counted over
distinct repositories and owners: a value of ``WIDE`` owners or more, or in ``WIDE_REPOS``
repositories or more, whoever owns them, is a copied example; one with fewer of both
that looks random is a live credential.  Live values are
then marked wherever they stand, also where no base pattern sees them: those bare
tokens are the spans that the method adds, kind ``owned``.

Here a repository is (source, lang) and an owner is a source.  Values are counted
per (value, owner, repository) first, with map-side combine; the classes are joined
back on (value, salt), so a value in a third of all rows meets many tasks.  Both joins
are sort-merge: their sides grow with the input, so neither may be broadcast.

Defined cases: a null text is empty and has no spans; a null source or lang is an
owner or repository part of its own; repeated rows get equal results; an empty
table gives an empty result; extra columns are ignored.
"""
from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import pick, small_batches, staged

# The base patterns, their kinds in order, and the least lengths.
KINDS = ["assign", "access", "hex", "owned"]
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")       # a run below 16 holds no other match, so it needn't be visited
LEAST_ASSIGN, LEAST_ACCESS = 12, 18

BARE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
LEAST_ENTROPY = 3.0                      # bits a character
WIDE = 3                                 # owners that make a value a copied example
WIDE_REPOS = 4                           # repositories that do so too
SALTS = 16


def looks_live(value: str) -> bool:
    """Mixed letters and digits, and spread out like a random string."""
    digits = sum(c.isdigit() for c in value)
    if digits < 3 or sum(c.isalpha() for c in value) < 3:
        return False
    n = len(value)
    return -sum(k / n * math.log2(k / n) for k in Counter(value).values()) >= LEAST_ENTROPY


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, value) of the base patterns, by start, then kind."""
    found = [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found)


def bare_spans(text: str, base: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """Candidate tokens that overlap no base span (these in order of their starts)."""
    out, at, covered = [], 0, 0
    for m in BARE.finditer(text):
        while at < len(base) and base[at][0] < m.end():      # one walk over both: long texts have many of each
            covered = max(covered, base[at][2])
            at += 1
        if covered <= m.start() and looks_live(m[0]):
            out.append((m.start(), 3, m.end(), m[0]))
    return out


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def entry(s):
        start, kind, end, value = s
        value = value.strip("=.-")
        h = xxhash.xxh64_intdigest(value.encode("utf-8", "surrogatepass"))
        return {"start": start, "kind": kind, "end": end, "value": h - (1 << 63), "live": kind == 1 or looks_live(value)}
    for b in batches:
        found = []
        for t in b["text"]:
            t = t if isinstance(t, str) else ""
            base = base_spans(t)
            found.append([entry(s) for s in base + bare_spans(t, base)])
        yield pd.DataFrame({"row": b["row"], "doc_id": b["doc_id"], "owner": b["owner"], "repo": b["repo"], "found": found})


FOUND = "array<struct<start:long,kind:int,end:long,value:long,live:boolean>>"


def scan(docs: DataFrame) -> DataFrame:
    """row, doc_id, owner, repo, found: one row for each row of ``docs``."""
    small_batches(docs.sparkSession)
    named = pick(docs, "doc_id", "text", "lang", "source").select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "text",
        F.coalesce("source", F.lit("\x00")).alias("owner"), F.coalesce("lang", F.lit("\x00")).alias("repo"))
    return staged(named.mapInPandas(_scan, f"row long, doc_id long, owner string, repo string, found {FOUND}"), "secrets")


def ownership(scanned: DataFrame) -> DataFrame:
    """value, n_docs, n_repos, n_owners: how widely each candidate is spread."""
    seen = scanned.select("owner", "repo", F.explode(F.array_distinct("found.value")).alias("value"))
    return (seen.groupBy("value", "owner", "repo").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("value", "owner").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("repos"))
            .groupBy("value").agg(F.sum("n").alias("n_docs"), F.sum("repos").alias("n_repos"),
                                  F.count(F.lit(1)).alias("n_owners")))


def find_secrets(docs: DataFrame, wide: int = WIDE, wide_repos: int = WIDE_REPOS) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example, and of the row's
    candidates the most owners and repositories that one has."""
    scanned = scan(docs)
    classes = ownership(scanned).select(
        "value", "n_owners", "n_repos", ((F.col("n_owners") >= wide) | (F.col("n_repos") >= wide_repos)).alias("example"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    single = scanned.where(F.size("found") > 0).select(
        "row", F.explode("found").alias("f"), F.pmod("row", F.lit(SALTS)).cast("int").alias("salt")
    ).select("row", "salt", "f.*")
    judged = single.join(classes.hint("merge"), ["value", "salt"])
    live = F.col("live") & ~F.col("example")
    span = F.struct("start", "kind", "end")
    per_row = judged.groupBy("row").agg(
        F.collect_list(F.when((F.col("kind") < 3) | live, span)).alias("all"),
        F.sum(live.cast("long")).alias("n_live"), F.sum(F.col("example").cast("long")).alias("n_example"),
        F.max("n_owners").alias("most_owners"), F.max("n_repos").alias("most_repos"))
    # rows without candidates need no join
    of = lambda k: F.size(F.filter("found", lambda s: s["kind"] == k)).cast("long")
    names = F.array(*[F.lit(k) for k in KINDS])

    def joined(spans):
        text = F.transform(spans, lambda s: F.concat_ws(
            ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(text, ",")

    base = F.transform(F.filter("found", lambda s: s["kind"] < 3),
                       lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    cols = ["row", "doc_id", of(0).alias("n_assign"), of(1).alias("n_access"), of(2).alias("n_hex"),
            F.sha2(joined(F.sort_array(base)).cast("binary"), 256).alias("base_sha256")]
    have = scanned.where(F.size("found") > 0).select(*cols).join(per_row.hint("merge"), "row").select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", joined(F.sort_array("all")).alias("spans"),
        "n_live", "n_example", "most_owners", "most_repos")
    none = scanned.where(F.size("found") == 0).select(*cols).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", F.lit("").alias("spans"),
        *[F.lit(0).cast("long").alias(c) for c in ("n_live", "n_example", "most_owners", "most_repos")])
    return have.unionByName(none)
