"""The composed stages with given labels and fixed plug-ins, so that SQL can check them.

Clustering a table is the one step of the stages that SQL can't express; here the
labels come from columns (the source's number, the arrival number), and embeddings and
answers from small functions of the text, passed in like any user's plug-ins.
Everything else is the stages' own code over whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from needlens.plans.collect import collect
from needlens.sources.posts import posts_from_documents
from needlens.sources.tables import load


def plugins():
    """Fixed embedding and answer functions (nested: shipped to executors by value)."""
    def embed(texts):
        return [[float(t.count("e")), float(t.count("t")), float(len(t) % 97 + 1)] for t in texts]

    def need(text):
        n = len(text)
        if n % 13 == 0:
            return "no answer"
        return {"is_financial": n % 11 != 0, "entity": "" if n % 4 == 0 else f"entity{n % 4}", "feature": f"f{n % 5}",
                "opinion": "" if n % 9 == 0 else f"opinion of {text[:25]}", "need_type": "explicit" if n % 2 else "wish",
                "pain_point": [None, ""][n % 5] if n % 5 < 2 else f"pain with {text[:30]}",
                "root_cause": f"cause{n % 6}" if n % 6 else None, "sentiment": ("positive", "negative", "mixed")[n % 3],
                "emotion": ("fear", "joy", "", "anger", "curiosity")[n % 5], "intensity": n % 10 / 5,
                "evidence": "" if n % 8 == 0 else f"quote {text[:20]}",
                "user_type": ("trader", "developer", "casual", "robot")[n % 4], "experience_level": ("beginner", "expert")[n % 2]}

    def name(words, first):
        return ("Sorry, no name.", {"name": 5, "description": "x"},
                {"name": f"{words[0]} {first[:12]}", "description": f"About {words[-1]}"})[len(words[0]) % 3]

    def tools(words):
        return {"solutions": ([{"name": f"Tool {words[0]}", "coverage": "full"}], [{"name": "X"}], [], ["text"])[len(words[0]) % 4]}

    def spec(need_name):
        return ({"skill_name": "fixed-skill", "importance": 9, "satisfaction": "2", "has_mature_solution": "true"},
                {"skill_name": f"s-{len(need_name)}"}, "nothing")[len(need_name) % 3]

    def answer(prompts):
        import json
        out = []
        for p in prompts:
            words = p.split("Keywords: ", 1)[-1].split("\n", 1)[0].split(", ")
            if "Name the group" in p:
                got = name(words, p.split("Typical posts:\n- ", 1)[-1])
            elif "List known tools" in p:
                got = tools(words)
            elif "Design an assistant skill" in p:
                got = spec(p.split("Need: ", 1)[1].split("\nDescription: ", 1)[0])
            else:
                got = need(p.split("Post:\n", 1)[1])
            out.append(got if isinstance(got, str) else json.dumps(got, ensure_ascii=False))
        return out
    return embed, answer


def posts(spark, sf_dir) -> DataFrame:
    """Documents as posts, one an hour in the order of their ids."""
    hour = F.timestamp_seconds(F.lit(1705312800) + F.col("ord") * 3600)
    return posts_from_documents(load(spark, sf_dir, "documents")).withColumn("timestamp", hour)


def states(spark, sf_dir) -> DataFrame:
    """A velocity for each topic, from its number of documents."""
    docs = load(spark, sf_dir, "documents").groupBy(F.col("source").alias("topic")).agg(F.count(F.lit(1)).alias("n"))
    return docs.select("topic", ((F.col("n") % 7 - 3) / 20).alias("velocity"))


def topic_labels(rows: DataFrame) -> DataFrame:
    """The number of the source; every fifth source is noise."""
    number = F.substring("topic", 4, 9).try_cast("int")
    return rows.select("ord", F.when(number % 5 != 4, number).alias("cluster_id"))


def need_labels(rows: DataFrame) -> DataFrame:
    """The arrival number modulo seven; six is noise."""
    part = (F.col("ord") % 7).cast("int")
    return rows.select("ord", F.when(part != 6, part).alias("cluster_id"))


def topic_stage(spark, sf_dir):
    """Topic clustering of the cleaned documents."""
    from needlens.plans.topics import cluster_topics
    embed, answer = plugins()
    t = cluster_topics(collect(posts(spark, sf_dir), "text"), embed_fn=embed, answer_fn=answer, labels=topic_labels)
    return t.select("post_id", "cluster_id", "topic_label", F.array_join("topic_keywords", ",").alias("topic_keywords"))


def _run(spark, sf_dir):
    from needlens.plans.run import run
    embed, answer = plugins()
    return run(posts(spark, sf_dir), states(spark, sf_dir), dedup_key="text", embed_fn=embed, answer_fn=answer,
               topic_labels=topic_labels, need_labels=need_labels)


def need_stage(spark, sf_dir):
    """L2 and L3 (C5, C12, P15, P17-P19, F3, F4, A1-A8, C9-C11): ranked need clusters."""
    c = _run(spark, sf_dir).clusters
    people = F.transform("personas", lambda p: F.concat_ws(":", p["segment_name"], p["post_count"].cast("string"),
                                                          p["pct"].cast("string"), p["experience_level"]))
    return c.select(
        "rank", "need_cluster_id", "cluster_name", "description", "post_count", "trend",
        F.array_join("keywords", ",").alias("keywords"), F.array_join("evidence_samples", "|").alias("evidence"),
        F.array_join("top_scenarios", ",").alias("scenarios"), F.array_join(people, ",").alias("personas"),
        F.col("emotion_profile.dominant_emotion").alias("dominant_emotion"),
        F.col("emotion_profile.avg_intensity").alias("avg_intensity"),
        F.array_join(F.map_keys("emotion_profile.emotion_distribution"), ",").alias("emotions"),
        F.array_join(F.transform("existing_solutions", lambda s: F.concat_ws(":", s["name"], s["coverage"], s["limitation"])),
                     ",").alias("solutions"),
        F.array_join("source_topics", ",").alias("source_topics"),
        F.array_join("source_topic_labels", "|").alias("source_topic_labels"),
        F.col("opportunity.raw_score").alias("raw_score"), F.col("opportunity.final_score").alias("final_score"))


def full_run(spark, sf_dir):
    """The specs of a whole run."""
    res = _run(spark, sf_dir)
    return res.specs.select(
        "rank", "source_cluster_id", "skill_name", "need_name", "need_type", "need_description", "post_count", "data_period",
        F.array_join("evidence", "|").alias("evidence"), F.col("opportunity.importance").alias("importance"),
        F.col("opportunity.satisfaction").alias("satisfaction"), F.col("opportunity.raw_score").alias("raw_score"),
        F.col("opportunity.trend_boost").alias("trend_boost"), F.col("opportunity.final_score").alias("final_score"))


def run_metrics(spark, sf_dir):
    """Raw, dropped, kept, clustered, noise, off-domain and failed counts of a run."""
    return _run(spark, sf_dir).metrics
