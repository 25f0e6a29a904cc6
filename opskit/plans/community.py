"""Question-and-answer site reports over posts, users, votes, tags, badges and comments.

``tables`` is any object with those relations as attributes.  Votes and other large facts
are aggregated to one row per key before they are joined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from opskit.functions import clock, text, units
from opskit.operators.aggregates import counts_per_key, string_agg, top_k
from opskit.operators.joins import attach_scalar, head_to_head as duel
from opskit.operators.ordered import global_row_number, row_number_in

E = F.expr

# Type codes.
QUESTION, ANSWER = 1, 2
UP, DOWN, BOUNTY = 2, 3, 9
DUPLICATE_LINK, CLOSED = 3, 10


def _votes(t, kind: int) -> DataFrame:
    """Votes of one kind per post."""
    return t.votes.filter(F.col("vote_type_id") == kind).groupBy("post_id").agg(F.count("*").alias("n"))


def _tag_upvotes(t, user, keep_wiki: bool = True) -> DataFrame:
    """Up votes on a user's answers per tag of the question."""
    mine = t.posts.filter((F.col("owner_user_id") == user) & F.col("parent_id").isNotNull())
    if not keep_wiki:
        mine = mine.filter("community_owned_date is null")
    got = mine.join(_votes(t, UP), E("id = post_id")).groupBy("parent_id").agg(F.sum("n").alias("n"))
    return t.post_tags.join(got, E("post_id = parent_id")).groupBy("tag_id").agg(F.sum("n").alias("up_votes"))


def interesting_unanswered(t, user, tags: int = 20, k: int = 2000) -> DataFrame:
    """Open questions in the user's best tags without a well-received answer, by weight."""
    best = top_k(_tag_upvotes(t, user), [F.col("up_votes").desc()], tags, ["tag_id"])
    good = t.posts.filter("score > 0 and parent_id is not null").select(F.col("parent_id").alias("id"))
    asked = t.posts.filter(
        "community_owned_date is null and closed_date is null and parent_id is null and accepted_answer_id is null")
    weight = (
        t.post_tags.join(F.broadcast(best), "tag_id").groupBy(F.col("post_id").alias("id")).agg(F.sum("up_votes").alias("w")))
    d = (
        asked.join(good, "id", "left_anti").join(weight, "id")
        .join(t.users.select(F.col("id").alias("owner_user_id"), "reputation"), "owner_user_id")
    )
    d = d.select("id", (F.col("w") / 10.0 + F.col("reputation") / 200.0 + F.col("score") * 100).cast("double").alias("weight"))
    return top_k(d, [F.col("weight").desc()], k, ["id"])


def rare_upvoters(t, min_reputation: int, min_up: int, k: int = 100) -> DataFrame:
    ratio = F.round(E("cast(100 * (reputation div 10) as double) / (up_votes + 1)"), 2)
    d = t.users.filter((F.col("reputation") > min_reputation) & (F.col("up_votes") > min_up)).select(
        "id", ratio.alias("ratio_percent"), "reputation", "up_votes", "down_votes")
    return top_k(d, [F.col("ratio_percent").desc()], k, ["id"])


def _accepted(t) -> DataFrame:
    """Accepted answers with the asker of their question."""
    q = t.posts.filter("accepted_answer_id is not null").select(
        F.col("accepted_answer_id").alias("id"), F.col("owner_user_id").alias("asker"), F.col("id").alias("question_id"))
    return t.posts.join(q, "id")


def user_score(t, user) -> DataFrame:
    """Accepted answers of a user to others: scored, unscored and percent unscored."""
    a = _accepted(t).filter(
        (F.col("owner_user_id") == user) & (F.col("asker") != user) & F.col("community_owned_date").isNull() & (F.col("post_type_id") == ANSWER))
    zero = F.count_if(F.col("score") == 0)
    return a.agg(F.count("*").alias("accepted"), F.count_if(F.col("score") != 0).alias("scored"), zero.alias("unscored")).withColumn(
        "percent_unscored", units.int_div(F.col("unscored") * 1000, "accepted") / 10.0)


def user_upvotes(t, user) -> DataFrame:
    return _tag_upvotes(t, user).join(t.tags, E("tag_id = id")).select("tag_name", "up_votes")


def badge_progress(t, user, k: int = 20) -> DataFrame:
    d = _tag_upvotes(t, user, keep_wiki=False).join(t.tags, E("tag_id = id")).select("tag_name", "up_votes")
    return top_k(d, [F.col("up_votes").desc()], k, ["tag_name"])


def low_views_high_votes(t, k: int = 500) -> DataFrame:
    d = t.posts.filter("score > 2 and view_count <> 0 and parent_id is null and accepted_answer_id is null")
    return top_k(d.select("id", "score", "view_count"), [F.col("view_count").asc()], k, ["id"])


def controversial_posts(t, k: int = 100) -> DataFrame:
    v = F.col("vote_type_id")
    per = t.votes.filter(v.isin(UP, DOWN)).groupBy("post_id").agg(F.count_if(v == UP).alias("up"), F.count_if(v == DOWN).alias("down"))
    d = per.filter("down > up * 0.5").join(t.posts.filter("community_owned_date is null and closed_date is null"), E("post_id = id"))
    return top_k(d.select("id", "up", "down"), [F.col("up").desc()], k, ["id"])


def comment_scores(t, user) -> DataFrame:
    return t.comments.filter(F.col("user_id") == user).groupBy("score").agg(F.count("*").alias("comments"))


def rank_percentile(t, user) -> DataFrame:
    """Rank by reputation and rank / number of users above 100."""
    base = t.users.agg(F.count_if(F.col("reputation") > 100)).scalar()
    ranked = global_row_number(t.users.select("id", "reputation"), [F.col("reputation").desc(), F.col("id").asc()], "ranking")
    return ranked.filter(F.col("id") == user).select("id", "ranking", (F.col("ranking").cast("decimal(20,5)") / base).cast("double").alias("percentile"))


def prolific_editors(t, k: int = 50) -> DataFrame:
    edits = t.posts.filter("last_editor_user_id <> owner_user_id").drop("id")
    kind = F.col("post_type_id")
    d = counts_per_key(t.users.select("id"), "id", edits, "last_editor_user_id", {
        "question_edits": kind == QUESTION, "answer_edits": kind == ANSWER, "total_edits": F.lit(True)})
    return top_k(d, [F.col("total_edits").desc()], k, ["id"])


def top_answerers(t, k: int = 500) -> DataFrame:
    a = t.posts.filter("post_type_id = 2 and community_owned_date is null and closed_date is null")
    per = a.groupBy("owner_user_id").agg(F.count("*").alias("answers"), F.avg(F.col("score").cast("double")).cast("decimal(6,2)").alias("average_score"))
    d = per.filter("answers > 10").join(t.users.select(F.col("id").alias("owner_user_id")), "owner_user_id", "left_semi")
    return top_k(d.withColumnRenamed("owner_user_id", "id"), [F.col("average_score").desc()], k, ["id"])


def accept_rate(t, min_answers: int, k: int = 100) -> DataFrame:
    """Share of a user's answers to other people's questions that were accepted."""
    q = t.posts.filter("post_type_id = 1").select(F.col("id").alias("parent_id"), F.col("owner_user_id").alias("asker"), "accepted_answer_id")
    a = t.posts.filter("post_type_id = 2 and owner_user_id is not null").drop("accepted_answer_id").join(q, "parent_id")
    a = a.filter("asker is null or asker <> owner_user_id")
    per = a.groupBy(F.col("owner_user_id").alias("id")).agg(
        F.count("*").alias("answers"), F.count_if(F.col("accepted_answer_id") == F.col("id")).alias("accepted"))
    d = per.filter(F.col("answers") >= min_answers).withColumn("accept_percent", F.col("accepted") * 100.0 / F.col("answers"))
    return top_k(d, [F.col("accept_percent").desc(), F.col("answers").desc()], k, ["id"])


def accepted_pct(t, user) -> DataFrame:
    mine = t.posts.filter((F.col("owner_user_id") == user) & (F.col("post_type_id") == ANSWER))
    accepted = _accepted(t).filter((F.col("owner_user_id") == user) & (F.col("post_type_id") == ANSWER))
    return accepted.agg(F.count("*").alias("accepted")).select(
        F.try_divide(F.col("accepted").cast("double"), mine.agg(F.count("*")).scalar()).alias("_r")).select((F.col("_r") * 100).alias("accepted_percent"))


def bounties_by_month(t) -> DataFrame:
    ym = lambda c: [F.year(c).alias("year"), F.month(c).alias("month")]
    q = t.posts.filter("post_type_id = 1").groupBy(*ym("creation_date")).agg(F.count("*").alias("questions"))
    v = t.votes.filter(F.col("vote_type_id") == BOUNTY).groupBy(*ym("creation_date")).agg(
        F.count("*").alias("bounties"), F.sum("bounty_amount").alias("amount"))
    return q.join(v, ["year", "month"], "left")


def _monthly_fanout(t, duplicates_only: bool, distinct: bool) -> DataFrame:
    """Questions per month counted once per (history row, link), as outer joins fan out.

    The counts of both sides are multiplied instead of building the pairs.
    """
    h = t.post_history if not duplicates_only else t.post_history.filter(F.col("post_history_type_id") == CLOSED)
    l = t.post_links if not duplicates_only else t.post_links.filter(F.col("link_type_id") == DUPLICATE_LINK)
    hn = h.groupBy(F.col("post_id").alias("id")).agg(F.count("*").alias("h"))
    ln = l.groupBy(F.col("post_id").alias("id")).agg(F.count("*").alias("l"))
    how = "inner" if duplicates_only else "left"
    d = t.posts.filter("post_type_id = 1").join(hn, "id", how).join(ln, "id", how)
    rows = F.lit(1) if distinct else F.coalesce("h", F.lit(1)) * F.coalesce("l", F.lit(1))
    return d.groupBy(clock.fmt_date("creation_date", "yy-MM").alias("month")).agg(F.sum(rows).alias("cnt"))


def duplicates_by_month(t, distinct: bool = False) -> DataFrame:
    return _monthly_fanout(t, True, distinct)


def questions_by_month(t, distinct: bool = False) -> DataFrame:
    return _monthly_fanout(t, False, distinct)


def head_to_head(t, user, rival) -> DataFrame:
    return duel(t.posts.filter("post_type_id = 2"), "parent_id", "owner_user_id", "score", user, rival)


def most_downvoted(t, k: int = 20) -> DataFrame:
    """Top-k over one row per question, then only those rows fetch their body."""
    per = _votes(t, DOWN).withColumnRenamed("n", "vote_count")
    q = t.posts.filter("post_type_id = 1").select("id")
    best = top_k(per.join(q, E("post_id = id")).select("id", "vote_count"), [F.col("vote_count").desc()], k, ["id"])
    return F.broadcast(best).join(t.posts.select("id", "body"), "id")


def dangerous_tags(t, min_posts: int) -> DataFrame:
    """Up and down votes on answers per tag with enough posts, and the down/up ratio."""
    v = F.col("vote_type_id")
    per = t.votes.filter(v.isin(UP, DOWN)).groupBy("post_id").agg(F.count_if(v == UP).alias("u"), F.count_if(v == DOWN).alias("d"))
    a = t.posts.filter("parent_id is not null").join(per, E("id = post_id")).groupBy("parent_id").agg(F.sum("u").alias("u"), F.sum("d").alias("d"))
    tagged = t.post_tags.join(a, E("post_id = parent_id"), "left").groupBy("tag_id").agg(
        F.count("*").alias("posts"), F.coalesce(F.sum("u"), F.lit(0)).alias("up_votes"), F.coalesce(F.sum("d"), F.lit(0)).alias("down_votes"))
    ratio = F.round(F.try_divide(F.col("down_votes") * 100.0, F.col("up_votes").cast("double")), 2)
    return tagged.filter(F.col("posts") >= min_posts).join(t.tags, E("tag_id = id")).select("tag_name", "up_votes", "down_votes", ratio.alias("ratio"))


def popular_tags(t, start, end, min_total: int = 800) -> DataFrame:
    """Tags by posts in a period, with the rank in the period and of all time."""
    dated = t.post_tags.join(t.posts.select("id", "creation_date"), E("post_id = id")).withColumn(
        "_in", F.col("creation_date").between(start, end))
    per = dated.groupBy("tag_id").agg(F.count_if("_in").alias("period_posts"), F.count("*").alias("total_posts"))
    d = per.filter((F.col("period_posts") > 0) & (F.col("total_posts") > min_total)).join(t.tags, E("tag_id = id")).select("tag_name", "period_posts", "total_posts")
    d = global_row_number(d, [F.col("period_posts").desc(), F.col("tag_name").asc()], "period_rank")
    return global_row_number(d, [F.col("total_posts").desc(), F.col("tag_name").asc()], "total_rank")


def passive_reputation(t, user, ignore_days: int = 15, k: int = 100) -> DataFrame:
    """Reputation a user's older posts still earn per day, from late votes only."""
    mine = t.posts.filter((F.col("owner_user_id") == user) & F.col("community_owned_date").isNull())
    d = attach_scalar(mine.select("id", "parent_id", "creation_date"), t.posts.agg(F.max("creation_date").alias("latest")))
    age = clock.datediff_boundary("day", "creation_date", "latest")
    d = d.filter(age > ignore_days * 4)
    v = t.votes.filter(F.col("vote_type_id").isin(UP, DOWN)).select("post_id", "vote_type_id", F.col("creation_date").alias("voted"))
    j = d.join(v, E("id = post_id")).filter(clock.datediff_boundary("day", "creation_date", "voted") > ignore_days)
    up = F.when(F.col("vote_type_id") == UP, F.when(F.col("parent_id").isNull(), 5).otherwise(10)).otherwise(0)
    down = F.when(F.col("vote_type_id") == DOWN, 2).otherwise(0)
    g = j.groupBy("id", "creation_date", "latest").agg(F.sum(up).alias("up"), F.sum(down).alias("down"))
    days = clock.datediff_boundary("day", "creation_date", "latest") - ignore_days
    out = g.select("id", (F.col("up") - F.col("down")).alias("passive"), "up", "down", days.alias("days")).withColumn(
        "per_day", F.col("passive").cast("double") / F.col("days"))
    return top_k(out, [F.col("per_day").desc()], k, ["id"])


def short_titles(t, n: int) -> DataFrame:
    return t.posts.filter("parent_id is null").filter(text.trimmed_length("title") < n).select("id", "body", "score")


def thank_you_posts(t, needle: str = "hank", max_length: int = 200) -> DataFrame:
    a = t.posts.filter("post_type_id = 2").filter((text.trimmed_length("body") <= max_length) & F.col("body").contains(needle))
    return a.groupBy("parent_id").agg(F.count("*").alias("answers")).filter("answers > 1")


def quickest_badge(t, name: str) -> DataFrame:
    """Days of membership when a badge was won, and days since it was first awarded."""
    won = t.badges.filter(F.col("name") == name)
    d = won.select(F.col("id").alias("badge_id"), "user_id", "date").join(t.users.select(F.col("id").alias("user_id"), F.col("creation_date").alias("member_since")), "user_id")
    d = attach_scalar(d, won.agg(F.min("date").alias("first_time")))
    return d.select("badge_id", "user_id", (clock.datediff_boundary("day", "member_since", "date") + 1).alias("days_membership"),
                    clock.datediff_boundary("day", "first_time", "date").alias("days_since_first"))


def rising_stars(t, min_reputation: int = 5000, k: int = 50) -> DataFrame:
    d = attach_scalar(t.users.filter(F.col("reputation") > min_reputation), t.posts.agg(F.max("creation_date").alias("latest")))
    d = d.withColumn("days", clock.datediff_boundary("day", "creation_date", "latest"))
    d = d.withColumn("rep_per_day", units.int_div("reputation", "days"))
    return top_k(d.select("id", "reputation", "days", "rep_per_day"), [F.col("rep_per_day").desc()], k, ["id"])


def unsung_heroes(t, min_zero: int = 10) -> DataFrame:
    a = _accepted(t).filter("community_owned_date is null and owner_user_id is not null").filter(
        F.col("owner_user_id") != F.coalesce("asker", F.lit(-1)))
    per = a.groupBy(F.col("owner_user_id").alias("id")).agg(
        F.count_if(F.col("score") != 0).alias("scored"), F.count_if(F.col("score") == 0).alias("unscored")).filter(F.col("unscored") > min_zero)
    return per.join(t.users.select("id", "reputation"), "id").withColumn("ratio", F.col("unscored") / (F.col("unscored") + F.col("scored")))


def bounty_winners(t, k: int = 100) -> DataFrame:
    per = _votes(t, BOUNTY).join(t.posts.select("id", "owner_user_id"), E("post_id = id"))
    d = per.groupBy("owner_user_id").agg(F.sum("n").alias("bounties"))
    return top_k(d, [F.col("bounties").desc()], k, ["owner_user_id"])


def qa_by_bucket(t, n: int, days: int = 30, inclusive: bool = False) -> DataFrame:
    """Questions and answers in ``n`` buckets of 30 days back from the newest post (by id).

    Buckets are half open at their start; ``inclusive`` also counts an edge post in the
    neighbouring bucket.
    """
    newest = t.posts.agg(F.max_by("creation_date", "id").alias("newest"))
    d = attach_scalar(t.posts.select("parent_id", "creation_date"), newest)
    us = (clock.epoch_us("newest") - clock.epoch_us("creation_date")).cast("bigint")
    step = days * 86_400_000_000
    bucket = F.floor(us / F.lit(step)).cast("bigint") + 1
    d = d.withColumn("bucket", bucket)
    if inclusive:
        edge = (us % step == 0) & (us > 0)
        d = d.withColumn("bucket", F.explode(F.when(edge, F.array(F.col("bucket") - 1, F.col("bucket"))).otherwise(F.array("bucket"))))
    d = d.filter(F.col("bucket").between(1, n))
    return d.groupBy("bucket").agg(F.max("newest").alias("newest"), F.count_if(F.col("parent_id").isNull()).alias("questions"),
                                   F.count_if(F.col("parent_id").isNotNull()).alias("answers")).select(
        (F.col("newest") - F.make_dt_interval(days=(F.col("bucket") * days).cast("int"))).alias("start"), "questions", "answers")


def popular_ratio(t, badge: str, min_badges: int = 10, k: int = 100) -> DataFrame:
    pop = t.badges.filter(F.col("name") == badge).groupBy(F.col("user_id").alias("id")).agg(F.count("*").alias("badges")).filter(F.col("badges") >= min_badges)
    q = t.posts.filter("post_type_id = 1").groupBy(F.col("owner_user_id").alias("id")).agg(F.count("*").alias("questions"))
    d = t.users.select("id").join(pop, "id").join(q, "id").withColumn("ratio", F.col("badges") / F.col("questions"))
    return top_k(d, [F.col("ratio").desc()], k, ["id"])


def duplicate_accounts(t, min_reputation: int = 1000) -> DataFrame:
    """Accounts sharing an e-mail hash, one line per account by falling reputation."""
    active = F.count_if(F.col("reputation") > 10)
    sizes = t.users.filter("email_hash is not null").groupBy("email_hash").agg(
        F.count("*").alias("accounts"), F.sum("reputation").alias("_rep"), active.alias("_active"))
    hit = sizes.filter((F.col("accounts") > 1) & (F.col("_rep") > min_reputation) & (F.col("_active") > 1)).select("email_hash", "accounts")
    order = [F.col("reputation").desc(), F.col("id").asc()]
    ranked = row_number_in(t.users.join(hit, "email_hash"), ["email_hash"], order, "position")
    label = F.concat(F.col("id").cast("string"), F.lit(" ("), F.col("display_name"), F.lit(" "), F.col("reputation").cast("string"), F.lit(")"))
    return ranked.select("email_hash", "accounts", "position", label.alias("id_and_name"))


def self_accept_rate(t, min_accepted: int = 10, k: int = 100) -> DataFrame:
    own = _accepted(t).filter("owner_user_id = asker").groupBy(F.col("owner_user_id").alias("id")).agg(F.count("*").alias("accepted")).filter(F.col("accepted") > min_accepted)
    q = t.posts.filter("post_type_id = 1").groupBy(F.col("owner_user_id").alias("id")).agg(F.count("*").alias("questions"))
    d = t.users.select("id").join(own, "id").join(q, "id").select("id", (F.col("accepted").cast("double") / F.col("questions") * 100).alias("self_percent"))
    return top_k(d, [F.col("self_percent").desc()], k, ["id"])


def vanity_search(t, user, start, end) -> DataFrame:
    """Posts linking to a user's site, in their text or a comment, written by others."""
    url = F.regexp_replace(F.replace(F.col("website_url"), F.lit("http://"), F.lit("")), "/$", "")
    site = t.users.filter(F.col("id") == user).agg(F.max(url).alias("site"))
    in_posts = attach_scalar(t.posts.filter(F.col("last_activity_date").between(start, end)), site)
    in_comments = attach_scalar(t.comments.filter(F.col("creation_date").between(start, end)), site)
    hit = lambda col: (F.col("site") != "") & F.contains(F.col(col), F.col("site"))
    a = in_posts.filter(hit("body") & (F.col("owner_user_id") != user)).select("id")
    c = in_comments.filter(hit("text") & (F.col("user_id") != user)).select(F.col("post_id").alias("id"))
    found = a.union(c).distinct()
    return t.posts.select("id", "last_activity_date").join(found, "id")


def users_by_location(t, needle: str) -> DataFrame:
    return t.users.filter(F.col("location").contains(needle))


def posts_by_location(t, needle: str, k: int = 1000) -> DataFrame:
    """Posts of users in a place with their comments and commenters, newest top-k."""
    here = users_by_location(t, needle).select(F.col("id").alias("owner_user_id"), F.col("display_name").alias("author"))
    p = t.posts.select(F.col("id").alias("post_id"), "owner_user_id", "score").join(here, "owner_user_id")
    c = t.comments.select(F.col("id").alias("comment_id"), "post_id", "user_id")
    u = t.users.select(F.col("id").alias("user_id"), F.col("display_name").alias("commenter"))
    d = p.join(c, "post_id", "left").join(u, "user_id", "left").select("post_id", "author", "score", "comment_id", "commenter")
    return top_k(d, [F.col("score").desc()], k, ["post_id", "comment_id"])


def voteless_users(t, reputation: int, votes_by_user: DataFrame, key: str = "user_id") -> DataFrame:
    v = votes_by_user.select(F.col(key).alias("id"))
    return t.users.filter(F.col("reputation") == reputation).join(v, "id", "left_anti")


def votes_by_month(t) -> DataFrame:
    """Votes and average bounty per month; the average of whole numbers is truncated."""
    avg = units.int_div(F.sum("bounty_amount"), F.count("bounty_amount"))
    return t.votes.groupBy(F.year("creation_date").alias("year"), F.month("creation_date").alias("month")).agg(
        F.count("*").alias("votes"), avg.alias("average_bounty"))


