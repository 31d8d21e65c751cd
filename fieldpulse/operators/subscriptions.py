"""Which subscriptions a message goes to, by topic filters with wildcards.

A filter is a path of levels; ``+`` stands for one level and a last ``#`` for any number of further levels, none included. All filters together form a
trie, and a topic walks it level by level, along its own level and along ``+``. Each step is a join of the topics that are still on a path with the
trie's nodes of the next depth, so a topic is compared with no filter it has nothing in common with, and every topic walks once, however many
messages it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldpulse.session import scratch_dir

ONE, REST = "+", "#"


def _path(levels: Column, depth: Column) -> Column:
    """A node: the first levels of a filter, each after a slash, as a level may be empty but holds no slash."""
    return F.concat(F.lit(""), F.array_join(F.transform(F.slice(levels, 1, depth), lambda level: F.concat(F.lit("/"), level)), ""))


def valid_filter(topic_filter: Column) -> Column:
    """A filter has a character, ``+`` and ``#`` fill a level of their own, and ``#`` is the last one."""
    levels = F.split(topic_filter, "/")
    whole = F.forall(levels, lambda level: (level.isin(ONE, REST)) | ~F.regexp_like(level, F.lit("[+#]")))
    return F.coalesce((topic_filter != "") & whole & ~F.exists(F.slice(levels, 1, F.size(levels) - 1), lambda level: level == REST), F.lit(False))


def valid_topic(topic: Column) -> Column:
    return F.coalesce((topic != "") & ~F.regexp_like(topic, F.lit("[+#]")), F.lit(False))


def matching_topics(topics: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """(topic, subscription) for the distinct ``topics(topic)`` and ``subscriptions(subscription, topic_filter)``, each pair once.

    A wildcard at the first level takes no topic that begins with ``$``. Filters and topics that are not valid match nothing.
    """
    levels = F.split("topic_filter", "/")
    filters = _written(subscriptions.where(valid_filter(F.col("topic_filter"))).select(
        "subscription", levels.alias("levels"), (F.element_at(levels, -1) == REST).alias("rest")).withColumn(
        "depth", F.size("levels") - F.col("rest").cast("int")).withColumn("node", _path(F.col("levels"), F.col("depth"))), "filters")
    deepest = filters.agg(F.max("depth")).first()[0]
    walking = topics.select("topic").where(valid_topic(F.col("topic"))).distinct().select("topic", F.split("topic", "/").alias("levels"), F.lit("").alias("node"))
    if deepest is None:
        return filters.select(F.lit("").alias("topic"), "subscription")
    found = None
    for depth in range(deepest + 1):
        walking = _written(walking, "topics-on-the-way")
        # A filter ends here if the topic does, or if any rest will do.
        here = filters.where(F.col("depth") == depth).select("subscription", "node", "rest")
        ends = walking.join(here, "node").where((F.col("rest") & ((F.lit(depth) > 0) | ~F.col("topic").startswith("$"))) | (~F.col("rest") & (F.size("levels") == depth)))
        found = ends.select("topic", "subscription") if found is None else found.unionByName(ends.select("topic", "subscription"))
        nodes = filters.where(F.col("depth") > depth).select(_path(F.col("levels"), F.lit(depth + 1)).alias("node")).distinct()
        level = F.get("levels", F.lit(depth))
        steps = F.array(level, F.when((F.lit(depth) > 0) | ~F.col("topic").startswith("$"), F.lit(ONE)))
        walking = (walking.where(F.size("levels") > depth).withColumn("_step", F.explode(steps)).where("_step is not null")
                   .withColumn("node", F.concat("node", F.lit("/"), "_step")).drop("_step").join(nodes, "node", "left_semi").select("topic", "levels", "node"))
    return found.distinct()


def subscription_match(messages: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Each message once per subscription whose filters match its topic; a subscription may have several filters."""
    return messages.join(_written(matching_topics(messages, subscriptions), "matches"), "topic")


def _written(frame: DataFrame, purpose: str) -> DataFrame:
    path = scratch_dir(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
