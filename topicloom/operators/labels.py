"""Prompt texts for topics and communities, and labels from responses or from title terms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import is_noise
from ..functions.responses import community_label, response_label, response_tags
from ..settings import PROMPT_CHARS, PROMPT_LABELS, PROMPT_TITLES

# fixed values: line forms of the prompt texts
TITLE_LINE = "TITLE: "
LABEL_LINE = "LABEL: "
TAG_LINE = "TAG: "


def _fitting(lines: DataFrame, key: str, order: list[str], budget: Column, most: int) -> DataFrame:
    """The longest prefix of each key's lines that fits the budget.

    A line has a fixed marker and a line break, so only a bounded number of lines can fit. The rank
    filter comes before the running sum, which lets each map task keep that many rows per key and
    no key is gathered whole.
    """
    ranked = Window.partitionBy(key).orderBy(*order)
    running = ranked.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    head = lines.withColumn("__r", F.row_number().over(ranked)).where(F.col("__r") <= most)
    return (head.withColumn("__used", F.sum(F.char_length("line")).over(running))
            .where(F.col("__used") <= budget))


def _text(lines: DataFrame, key: str, name: str) -> DataFrame:
    ordered = F.array_sort(F.collect_list(F.struct("__r", "line")))
    return lines.groupBy(key).agg(F.array_join(F.transform(ordered, lambda e: e["line"]), "").alias(name))


def _line(marker: str, value: str) -> Column:
    return F.concat(F.lit(marker), F.coalesce(F.col(value), F.lit("")), F.lit("\n")).alias("line")


def cluster_prompts(docs: DataFrame, key: str = "cluster") -> DataFrame:
    """``(key, prompt)``: title lines in url order up to the character budget; no noise topics."""
    lines = docs.where(~is_noise(F.col(key))).select(key, "url", _line(TITLE_LINE, "title"))
    most = PROMPT_CHARS // (len(TITLE_LINE) + 1)
    texts = _text(_fitting(lines, key, ["url"], F.lit(PROMPT_CHARS), most), key, "prompt")
    return (lines.select(key).distinct().join(texts, key, "left")
            .select(key, F.coalesce("prompt", F.lit("")).alias("prompt")))


def community_prompts(labels: DataFrame, titles: DataFrame, tags: DataFrame) -> DataFrame:
    """``(community_id, prompt)`` from ``labels(community_id, cluster_id, cluster_label)``,
    ``titles(community_id, url, title)`` and ``tags(community_id, tag)``.

    At most 30 labels, then at most 30 titles, then the distinct tags, each section the longest
    prefix of what the earlier ones left of the budget.
    """
    key = "community_id"

    def section(lines: DataFrame, order: list[str], most: int, used: DataFrame | None, name: str):
        if used is not None:
            lines = lines.join(used, key, "left")
            budget = F.lit(PROMPT_CHARS) - F.coalesce("used", F.lit(0))
        else:
            budget = F.lit(PROMPT_CHARS)
        kept = _fitting(lines, key, order, budget, most)
        return _text(kept, key, name)

    def spent(*texts: DataFrame) -> DataFrame:
        rows = None
        for t in texts:
            part = t.select(key, F.char_length(t.columns[1]).alias("n"))
            rows = part if rows is None else rows.unionByName(part)
        return rows.groupBy(key).agg(F.sum("n").alias("used"))

    first = section(labels.select(key, "cluster_id", _line(LABEL_LINE, "cluster_label")), ["cluster_id"],
                    PROMPT_LABELS, None, "a")
    second = section(titles.select(key, "url", _line(TITLE_LINE, "title")), ["url"], PROMPT_TITLES, spent(first), "b")
    third = section(tags.select(key, "tag").distinct().select(key, "tag", _line(TAG_LINE, "tag")), ["tag"],
                    PROMPT_CHARS // (len(TAG_LINE) + 1), spent(first, second), "c")
    keys = labels.select(key).unionByName(titles.select(key)).unionByName(tags.select(key)).distinct()
    return (keys.join(first, key, "left").join(second, key, "left").join(third, key, "left")
            .select(key, F.concat(*[F.coalesce(c, F.lit("")) for c in "abc"]).alias("prompt")))


def labels_from_responses(responses: DataFrame, key: str = "cluster_id") -> DataFrame:
    """``(key, cluster_label, tags)`` from a table of response texts; noise gets an empty label."""
    noise = is_noise(F.col(key))
    none = F.array().cast("array<string>")
    return responses.select(
        key, F.when(noise, F.lit("")).otherwise(response_label(F.col("response"))).alias("cluster_label"),
        F.when(noise, none).otherwise(response_tags(F.col("response"))).alias("tags"))


def community_labels_from_responses(responses: DataFrame) -> DataFrame:
    return responses.select("community_id", community_label(F.col("response")).alias("community_label"))


def title_terms(rows: DataFrame, key: str, text: str = "title", k: int = 5) -> DataFrame:
    """``(key, rank, term, score)``: the ``k`` terms of a topic's titles with the highest
    tf · ln(1 + topics / topics with the term); ties by term. Noise topics have none.

    This stands in for a hosted labelling service when no response table is given.
    """
    real = rows.where(~is_noise(F.col(key)))
    words = real.select(key, F.explode(F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}{3,})"), F.lit(1))).alias("term"))
    tf = words.groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))
    df = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    n = real.agg(F.count_distinct(key).alias("topics")).withColumn("__one", F.lit(1))
    scored = (tf.join(df, "term").withColumn("__one", F.lit(1)).join(F.broadcast(n), "__one")
              .withColumn("score", F.round(F.col("tf") * F.log1p(F.col("topics") / F.col("df")), 6)))
    ranked = Window.partitionBy(key).orderBy(F.desc("score"), "term")
    return (scored.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
            .select(key, "rank", "term", "score"))


def labels_from_titles(rows: DataFrame, key: str, name: str = "cluster_label", text: str = "title") -> DataFrame:
    """``(key, label, tags)``: the top three terms as label, the top five as tags."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", "term")))
    terms = title_terms(rows, key, text).groupBy(key).agg(F.transform(ordered, lambda e: e["term"]).alias("tags"))
    return (rows.select(key).distinct().join(terms, key, "left")
            .select(key, F.coalesce(F.array_join(F.slice("tags", 1, 3), " "), F.lit("")).alias(name),
                    F.coalesce("tags", F.array().cast("array<string>")).alias("tags")))
