"""Secret scans with corpus-wide ownership of each candidate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .common import BROADCAST_IDS, let, prepare_texts, quoted, whole

#: Patterns by kind, in the order in which kinds are listed. ``assign`` matches are cut by their second group.
PATTERNS = {
    "assign": r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
              r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{14,}",
    "hex": r"[0-9a-f]{16,}",
    "mixed": r"[A-Za-z0-9+/_-]{20,}",
}
BASE = ("assign", "access", "hex")
#: Shortest value of an assignment.
ASSIGNED = 12
#: A value in more sources than these is a widely copied example.
MAX_OWNERS, MAX_REPOSITORIES = 3, 6


def _value(kind: str, hit: str) -> str:
    return f"regexp_extract({hit}, {quoted(PATTERNS['assign'])}, 2)" if kind == "assign" else hit


def _passes(kind: str, hit: str) -> str:
    if kind == "assign":
        return f"length({_value(kind, hit)}) >= {ASSIGNED}"
    if kind == "mixed":
        return " and ".join(f"{hit} rlike '{c}'" for c in ("[A-Z]", "[a-z]", "[0-9]"))
    return "true"


def spans_sql(kind: str, text: str) -> str:
    """SQL for the matches of one kind as an array of ``(start, end, value)``, end exclusive.

    A match starts after the lengths of all gaps and matches before it: ``split`` gives the gaps between leftmost
    matches and ``regexp_extract_all`` the matches. The sums are formed twice over, first inside runs of about the
    square root of their number and then over the runs, so that a text of n matches costs n^1.5 additions of
    numbers and no array grows match by match.
    """
    pattern = quoted(PATTERNS[kind])
    none = "cast(array() as array<struct<s:bigint,e:bigint,v:string>>)"
    # lengths of a gap with its match; a run ends before the next begins
    steps = f"zip_with(slice(split(t, {pattern}, -1), 1, size(h)), h, (g, m) -> cast(length(g) + length(m) as bigint))"
    runs = "transform(sequence(0, cast((size(l) - 1) div w as int)), r -> slice(l, r * w + 1, w))"
    total = "aggregate({}, 0L, (a, x) -> a + x)".format
    totals = f"transform(p, q -> {total('q')})"
    begun = f"transform(c, (x, r) -> {total('slice(c, 1, r)')})"
    ends = f"flatten(zip_with(p, b, (q, o) -> transform(q, (x, i) -> o + {total('slice(q, 1, i + 1)')})))"
    ends = let("cast(ceil(sqrt(size(l))) as int)", "w", let(runs, "p", let(totals, "c", let(begun, "b", ends))))
    hits = f"zip_with({let(steps, 'l', ends)}, h, (e, m) -> named_struct('s', e - length(m), 'e', e, 'v', m))"
    kept = f"transform(filter({hits}, x -> {_passes(kind, 'x.v')}), x -> named_struct('s', x.s, 'e', x.e, 'v', {_value(kind, 'x.v')}))"
    found = let(f"regexp_extract_all(t, {pattern}, 0)", "h", f"if(size(h) = 0, {none}, {kept})")
    return let(text, "t", found)


def joined(spans: Column) -> Column:
    """``kind:start:end`` by start and then kind, comma-joined."""
    ordered = F.array_sort(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["rank"].alias("rank"), x["e"].alias("e"))))
    kinds = F.array(*map(F.lit, PATTERNS))
    return F.array_join(F.transform(ordered, lambda x: F.concat_ws(":", F.get(kinds, x["rank"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def candidates(docs: DataFrame, *, key: str, text: str, owner: str, repository: Column) -> DataFrame:
    """``(k, owner, repository, found)`` per document, with all matches of all kinds in one array."""
    rows = docs.select(F.col(key).alias("k"), F.col(owner).cast("string").alias("owner"), repository.cast("string").alias("repository"),
                       whole(text).alias("t"))
    def spans(rank: int, kind: str) -> Column:
        return F.transform(F.expr(spans_sql(kind, "t")), lambda x: F.struct(
            F.lit(rank).alias("rank"), x["s"].alias("s"), x["e"].alias("e"), F.sha2(x["v"], 256).alias("v")))

    every = [spans(rank, kind) for rank, kind in enumerate(PATTERNS)]
    return rows.select("k", "owner", "repository", F.concat(*every).alias("found"))


def ownership(found: DataFrame) -> DataFrame:
    """``(v, owners, repositories, live)`` per candidate value: in how many distinct owners and repositories it
    occurs. Occurrences are reduced to distinct triples first, which combines before the shuffle, so a value in
    every document is one row per owner and repository. An unknown owner or repository counts as one of its own."""
    seen = (found.select("owner", "repository", F.explode(F.array_distinct(F.transform("found", lambda x: x["v"]))).alias("v"))
            .select("v", F.coalesce("owner", F.lit("\0")).alias("o"), F.coalesce("repository", F.lit("\0")).alias("r")).distinct())
    by_owner = seen.groupBy("v", "o").agg(F.count(F.lit(1)).alias("n"))
    # repositories of different owners differ, so their numbers add up
    return (by_owner.groupBy("v").agg(F.count(F.lit(1)).alias("owners"), F.sum("n").alias("repositories"))
            .withColumn("live", (F.col("owners") <= MAX_OWNERS) & (F.col("repositories") <= MAX_REPOSITORIES)))


def scan(docs: DataFrame, *, key: str = "doc_id", text: str = "text", owner: str = "source", repository: Column | None = None) -> DataFrame:
    """``(key, found, n_live, n_copied)``: all spans of each document, each with its kind's rank, its value's
    digest and whether the value looks live.

    Candidates of the base kinds are always reported. ``mixed`` candidates (long runs of upper and lower case letters
    and digits) are reported only where their value looks live: it belongs to few owners and repositories, while
    an example from documentation is found with many. Counts cover the whole corpus.

    Null text counts as empty, a null owner as an unknown one, null and repeated keys keep their rows; an empty table
    gives an empty result. Other columns are ignored. A document's spans stay in one row.
    """
    prepare_texts(docs.sparkSession)
    repository = repository if repository is not None else F.concat_ws("/", owner, "lang")
    rows = cut(candidates(docs, key=key, text=text, owner=owner, repository=repository).withColumn("id", F.monotonically_increasing_id()), "secret-candidates")
    found = rows.where(F.size("found") > 0)
    marked = (found.select("id", F.explode("found").alias("x")).select("id", "x.*")
              .join(ownership(found).select("v", "owners", "repositories", "live"), "v")
              .where((F.col("rank") < len(BASE)) | F.col("live"))
              .groupBy("id").agg(F.sort_array(F.collect_list(F.struct("s", "rank", "e", "v", "owners", "repositories", "live"))).alias("spans")))
    none = F.array().cast("array<struct<s:bigint,rank:int,e:bigint,v:string,owners:bigint,repositories:bigint,live:boolean>>")
    out = rows.select("id", "k").join(marked, "id", "left").withColumn("spans", F.coalesce("spans", none))
    return out.select(F.col("k").alias(key), F.col("spans").alias("found"),
                      F.size(F.filter("spans", lambda x: x["live"])).cast("long").alias("n_live"),
                      F.size(F.filter("spans", lambda x: ~x["live"])).cast("long").alias("n_copied"))


def redact(docs: DataFrame, *, key: str = "doc_id", text: str = "text", mark: str = "[secret]", **options) -> DataFrame:
    """``docs`` with every live span replaced by ``mark``; widely copied examples stay. Overlapping spans are replaced as one.

    Spans belong to rows, ``key`` is not looked at. Null texts stay null, texts without a live span stay as they are, and
    all columns pass through, whatever their names; an empty table gives an empty one.
    """
    prepare_texts(docs.sparkSession)
    live = F.filter("found", lambda x: x["live"])
    rows = cut(docs.select(F.struct("*").alias("d"), F.monotonically_increasing_id().alias("row")), "secret-rows")
    owner, options = options.pop("owner", "source"), dict(options)
    texts = rows.select("row", *[F.col(f"d.`{c}`").alias(c) for c in dict.fromkeys((text, owner, "lang")) if c in docs.columns])
    hits = scan(texts, key="row", text=text, owner=owner, **options).where("n_live > 0").select(
        "row", F.transform(live, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))).alias("x"))
    hits = cut(hits, "secret-hits")
    few = (hits.agg(F.sum(F.size("x") + 1)).first()[0] or 0) <= BROADCAST_IDS
    rows = rows.join(F.broadcast(hits) if few else hits, "row", "left")
    t = f"d.`{text}`"
    clean = (f"aggregate(x, named_struct('at', 0L, 'out', ''), (a, x) -> named_struct('at', greatest(a.at, x.e), 'out', "
             f"if(x.s < a.at, a.out, concat(a.out, substring({t}, cast(a.at + 1 as int), cast(x.s - a.at as int)), '{mark}'))), "
             f"a -> concat(a.out, substring({t}, cast(a.at + 1 as int))))")
    new = F.when(F.col("x").isNotNull(), F.expr(clean)).otherwise(F.col(t))
    return rows.select(*[new.alias(c) if c == text else F.col(f"d.`{c}`") for c in docs.columns])
