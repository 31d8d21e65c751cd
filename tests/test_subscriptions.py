"""Topic filters against a plain matcher, level by level."""

import random

from fieldpulse.operators import subscriptions


def plain(topic, topic_filter):
    if not topic or not topic_filter or any(c in topic for c in "+#"):
        return False
    levels, wanted = topic.split("/"), topic_filter.split("/")
    if any(("+" in w or "#" in w) and len(w) > 1 for w in wanted) or "#" in wanted[:-1]:
        return False
    if topic.startswith("$") and wanted[0] in ("+", "#"):
        return False
    if wanted[-1] == "#":
        wanted = wanted[:-1]
        return len(levels) >= len(wanted) and all(w in ("+", level) for w, level in zip(wanted, levels))
    return len(levels) == len(wanted) and all(w in ("+", level) for w, level in zip(wanted, levels))


def test_filters_match_like_a_plain_matcher(spark):
    draw = random.Random(2)
    topics = {"/".join(draw.choice(["a", "b", "", "$s", "c d"]) for _ in range(draw.randrange(1, 5))) for _ in range(120)}
    topics |= {"a/+", "#", "a", "/", "$SYS/x", None, ""}
    filters = {(f"s{draw.randrange(12)}", "/".join(draw.choice(["a", "b", "", "+", "+", "#", "c d", "x+"]) for _ in range(draw.randrange(1, 5)))) for _ in range(90)}
    filters |= {("all", "#"), ("all", "a/#"), ("top", "+"), ("sys", "$SYS/#"), ("none", None), ("none", ""), ("slash", "/+")}
    messages = spark.createDataFrame([(topic, number) for number, topic in enumerate(topics, 1) for _ in range(2)], "topic string, n int")
    table = spark.createDataFrame(list(filters), "subscription string, topic_filter string")
    got = sorted((row.subscription, row.topic, row.n) for row in subscriptions.subscription_match(messages, table).collect())
    pairs = {(name, topic, number) for number, topic in enumerate(topics, 1) for name, wanted in filters if plain(topic, wanted)}
    assert got == sorted([*pairs, *pairs])


def test_no_valid_filter(spark):
    messages = spark.createDataFrame([("a", 1)], "topic string, n int")
    assert subscriptions.subscription_match(messages, spark.createDataFrame([("s", "a/#/b")], "subscription string, topic_filter string")).count() == 0
    assert subscriptions.subscription_match(messages.where("false"), spark.createDataFrame([("s", "a")], "subscription string, topic_filter string")).count() == 0
