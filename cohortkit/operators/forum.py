"""Forum tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortkit.functions.scale import count_if, salted_lookup

PREVIEW = 100  # characters of a post kept as preview (fixed value)
READER_ACTIONS = ["read", "read_inline", "pin", "upvote", "unvote", "follow_thread"]  # fixed values


def forum_posts(forum: DataFrame) -> DataFrame:
    """Posts classified as initial_post, response_post or comment, with thread opener and person answered."""
    c = F.col
    thread_post = (c("_type") == "CommentThread") & c("comment_thread_id").isNull() & c("parent_id").isNull()
    comment = (c("_type") == "Comment") & c("parent_id").isNotNull()
    response = (c("_type") == "Comment") & c("comment_thread_id").isNotNull() & c("parent_id").isNull()
    kind = F.when(thread_post, "initial_post").when(comment, "comment").when(response, "response_post")
    posts = forum.filter("mongoid IS NOT NULL").withColumn("slug_type", kind)
    rows = posts.filter("slug_type IS NOT NULL").select(
        "course_id", c("author_username").alias("username"), c("mongoid").alias("slug_id"), "slug_type",
        c("comment_thread_id").alias("thread_id"), "parent_id", c("title").alias("own_title"),
        c("created_at").alias("first_time"), F.substring("body", 1, PREVIEW).alias("body_preview"),
    )
    threads = posts.filter("slug_type = 'initial_post'").select(
        "course_id", c("mongoid").alias("thread_id"), c("author_username").alias("original_poster"), c("title").alias("thread_title"))
    authors = forum.select("course_id", c("mongoid").alias("parent_id"), c("author_username").alias("responded_to"))
    df = salted_lookup(rows, threads, ["course_id", "thread_id"], salt_by=["slug_id"])
    df = salted_lookup(df, authors, ["course_id", "parent_id"], salt_by=["slug_id"])
    own = c("slug_type") == "initial_post"
    return df.select(
        "course_id", "username", "slug_id", "slug_type", "thread_id", "parent_id", "original_poster",
        F.when(c("slug_type") == "comment", c("responded_to")).alias("responded_to"),
        F.when(own, c("own_title")).otherwise(c("thread_title")).alias("title"), "first_time", "body_preview",
    )


def forum_person(posts: DataFrame, events: DataFrame) -> DataFrame:
    """Writing and reading per (user, post): own posts joined with what the user did in the post's thread.

    Reader actions are summed per (user, thread) before they meet the thread's posts.
    """
    c = F.col
    act = c("forum_action")
    read = events.filter(act.isin(READER_ACTIONS) & (c("username") != "")).groupBy("course_id", "username", "thread_id").agg(
        F.min("time").alias("fe_first"), F.max("time").alias("fe_last"),
        count_if(act.isin("read", "read_inline")).alias("read"), count_if(act == "pin").alias("pinned"),
        count_if(act == "upvote").alias("upvoted"), count_if(act == "unvote").alias("unvoted"),
        count_if(act == "follow_thread").alias("followed"),
    )
    facts = ["slug_type", "thread_id", "parent_id", "original_poster", "responded_to", "title"]
    there = posts.filter("thread_id IS NOT NULL").select("course_id", "slug_id", *facts)
    seen = read.join(there, ["course_id", "thread_id"], "inner").withColumnsRenamed({f: f"fe_{f}" for f in facts})
    wrote = posts.filter("username IS NOT NULL AND username != ''").select(
        "course_id", "username", "slug_id", *facts, c("first_time").alias("pp_first"), F.lit(1).alias("pp_wrote"))
    both = wrote.join(seen, ["course_id", "username", "slug_id"], "full")
    mine = c("pp_wrote").isNotNull()
    keep = [F.when(mine, c(f)).otherwise(c(f"fe_{f}")).alias(f) if f in ("slug_type", "thread_id", "parent_id", "title")
            else F.coalesce(c(f), c(f"fe_{f}")).alias(f) for f in facts]
    pf, ff, fl = c("pp_first"), c("fe_first"), c("fe_last")
    return both.select(
        "course_id", "username", "slug_id", *keep, F.coalesce("pp_wrote", F.lit(0)).alias("wrote"),
        "read", "pinned", "upvoted", "unvoted", "followed",
        F.when(pf <= fl, pf).when(pf.isNotNull() & fl.isNull(), pf).otherwise(F.coalesce(ff, fl)).alias("first_time"),
        F.when(pf >= fl, pf).when(pf.isNotNull() & fl.isNull(), pf).otherwise(F.coalesce(fl, ff)).alias("last_time"),
    )
