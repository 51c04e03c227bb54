"""Messages of a publish/subscribe broker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import text
from ..session import materialize


def subscribe(messages: DataFrame, topic_filter: str) -> DataFrame:
    """Messages whose topic the filter accepts (``+`` one level, ``#`` the rest)."""
    return messages.where(text.matches_topic(F.col("topic"), topic_filter))


def satellite_rows(messages: DataFrame) -> DataFrame:
    """One row per satellite of every report; ``t`` is in epoch seconds."""
    report = F.from_json("value", schemas.SATELLITE)
    return messages.select("topic", report.alias("r")).select("topic", F.col("r.t").alias("t"), F.inline("r.d"))


def matching_filters(topics: DataFrame, filters: DataFrame) -> DataFrame:
    """(topic, filter): which of many filters accept which topic, each pair once.

    The filters form a trie whose nodes are their first levels. All topics walk down it
    side by side: at each level a topic's node and its next word, or ``+``, are joined
    with the trie's edges, so the work follows the edges that topics take and not
    the number of filters. ``#`` accepts what reaches its parent. A filter with ``#`` before
    its end accepts nothing, nor does NULL. Every level is stored; there are as many as the
    longest filter has.
    """
    known = filters.select("filter").where(F.col("filter").isNotNull()).distinct()
    known = known.withColumn("levels", F.split("filter", "/"))
    known = known.where(~F.array_contains(F.slice("levels", F.lit(1), F.size("levels") - 1), "#"))
    known = materialize(known, "filters")

    def node(length: Column) -> Column:
        return F.concat_ws("/", length, F.slice("levels", F.lit(1), length))

    steps = known.select("levels", F.posexplode("levels").alias("pos", "label"))
    edges = steps.select(node(F.col("pos")).alias("node"), "label", node(F.col("pos") + 1).alias("child")).distinct()
    edges = materialize(edges.where("label != '#'"), "edges")
    rest = F.element_at("levels", -1) == "#"
    end = F.size("levels") - rest.cast("int")
    ends = materialize(known.select(node(end).alias("node"), rest.alias("rest"), "filter"), "ends")

    walkers = topics.select("topic").where(F.col("topic").isNotNull()).distinct()
    walkers = walkers.withColumn("words", F.split("topic", "/")).withColumn("node", F.lit("0"))
    deepest = known.agg(F.coalesce(F.max(F.size("levels")), F.lit(0))).first()[0]
    found = None
    for depth in range(deepest + 1):
        if depth:
            word = F.element_at("words", depth)
            labels = F.explode(F.when(word == "", F.array(word)).otherwise(F.array(word, F.lit("+"))))
            # A level that is spelled + is met by the filter's + alone.
            onward = walkers.where(F.size("words") >= depth).withColumn("label", labels).distinct()
            walkers = onward.join(edges, ["node", "label"]).select("topic", "words", F.col("child").alias("node"))
        walkers = materialize(walkers, f"walkers_{depth}")
        at_end = F.col("rest") | (F.size("words") == depth)
        here = walkers.join(ends, "node").where(at_end).select("topic", "filter")
        found = here if found is None else found.union(here)
    return found


def route(messages: DataFrame, filters: DataFrame) -> DataFrame:
    """Every message with each filter that accepts its topic, in a column ``filter``."""
    return messages.join(matching_filters(messages, filters), "topic")
