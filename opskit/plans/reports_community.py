"""Community reports bound to the given tables (J)."""

from pyspark.sql import functions as F

from opskit.plans import bindings as b
from opskit.plans import community as cm
from opskit.plans.registry import report, stamp

E = F.expr
NAMES = ("posts", "users", "votes", "tags", "post_tags", "badges", "comments", "post_links", "post_history")


class Community:
    """The Q&A relations derived from the given tables."""

    def __init__(self, db):
        for name in NAMES:
            setattr(self, name, getattr(b, name)(db))


USER = 61
CTE = "WITH " + ", ".join(f"{n} AS {getattr(b, n.upper())}" for n in NAMES) + " "
TAGUP = f"""SELECT pt.tag_id, count(*) AS up_votes FROM post_tags pt JOIN posts a ON a.parent_id = pt.post_id JOIN votes v ON v.post_id = a.id AND v.vote_type_id = 2 WHERE a.owner_user_id = {USER}"""


def j(key, sql):
    def add(fn):
        return report(key, CTE + sql)(lambda db: fn(Community(db)))
    return add


@j("J01_interesting_unanswered", f"""
, best AS ({TAGUP} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20), w AS (SELECT pt.post_id, sum(up_votes)::BIGINT AS w FROM post_tags pt JOIN best USING (tag_id) GROUP BY 1)
SELECT q.id, w.w / 10.0::DOUBLE + u.reputation / 200.0::DOUBLE + q.score * 100 AS weight FROM posts q JOIN w ON w.post_id = q.id JOIN users u ON u.id = q.owner_user_id
WHERE q.parent_id IS NULL AND q.closed_date IS NULL AND q.community_owned_date IS NULL AND q.accepted_answer_id IS NULL AND NOT EXISTS (SELECT 1 FROM posts a WHERE a.parent_id = q.id AND a.score > 0)
ORDER BY 2 DESC, 1 LIMIT 2000""")
def _(t):
    return cm.interesting_unanswered(t, USER)


@j("J02_rare_upvoters", "SELECT id, round(100 * (reputation // 10)::DOUBLE / (up_votes + 1) + 1e-9, 2) AS ratio_percent, reputation, up_votes, down_votes FROM users WHERE reputation > 1000 AND up_votes > 100 ORDER BY 2 DESC, 1 LIMIT 100")
def _(t):
    return cm.rare_upvoters(t, 1000, 100)


@j("J03_user_score", f"""SELECT count(*) AS accepted, count(*) FILTER (a.score <> 0) AS scored, count(*) FILTER (a.score = 0) AS unscored, (count(*) FILTER (a.score = 0) * 1000 // count(*)) / 10.0::DOUBLE AS percent_unscored
FROM posts q JOIN posts a ON a.id = q.accepted_answer_id WHERE a.community_owned_date IS NULL AND a.owner_user_id = {USER} AND q.owner_user_id <> {USER} AND a.post_type_id = 2""")
def _(t):
    return cm.user_score(t, USER)


@j("J04_user_upvotes", f"SELECT tag_name, up_votes FROM ({TAGUP} GROUP BY 1) JOIN tags ON tags.id = tag_id")
def _(t):
    return cm.user_upvotes(t, USER)


@j("J05_badge_progress", f"SELECT tag_name, up_votes FROM ({TAGUP} AND a.community_owned_date IS NULL GROUP BY 1) JOIN tags ON tags.id = tag_id ORDER BY up_votes DESC, tag_name LIMIT 20")
def _(t):
    return cm.badge_progress(t, USER)


@j("J06_low_views_high_votes", "SELECT id, score, view_count FROM posts WHERE score > 2 AND view_count <> 0 AND parent_id IS NULL AND accepted_answer_id IS NULL ORDER BY view_count, id LIMIT 500")
def _(t):
    return cm.low_views_high_votes(t)


@j("J07_controversial_posts", """SELECT id, up, down FROM (SELECT post_id, count(*) FILTER (vote_type_id = 2) AS up, count(*) FILTER (vote_type_id = 3) AS down FROM votes WHERE vote_type_id IN (2, 3) GROUP BY 1) JOIN posts ON id = post_id
WHERE down > up * 0.5 AND community_owned_date IS NULL AND closed_date IS NULL ORDER BY up DESC, id LIMIT 100""")
def _(t):
    return cm.controversial_posts(t)


@j("J08_comment_scores", "SELECT score, count(*) AS comments FROM comments WHERE user_id = 7 GROUP BY 1")
def _(t):
    return cm.comment_scores(t, 7)


@j("J09_rank_percentile", f"SELECT id, ranking, round(ranking / (SELECT count(*) FROM users WHERE reputation > 100), 10) AS percentile FROM (SELECT id, row_number() OVER (ORDER BY reputation DESC, id) AS ranking FROM users) WHERE id = {USER}")
def _(t):
    return cm.rank_percentile(t, USER).withColumn("percentile", F.round("percentile", 10))


@j("J10_prolific_editors", """SELECT u.id, count(p.id) FILTER (post_type_id = 1) AS question_edits, count(p.id) FILTER (post_type_id = 2) AS answer_edits, count(p.id) AS total_edits
FROM users u LEFT JOIN posts p ON p.last_editor_user_id = u.id AND p.owner_user_id <> u.id GROUP BY 1 ORDER BY 4 DESC, 1 LIMIT 50""")
def _(t):
    return cm.prolific_editors(t)


@j("J11_top_answerers", """SELECT owner_user_id AS id, count(*) AS answers, round(avg(score) + 1e-9, 2) AS average_score FROM posts JOIN users u ON u.id = owner_user_id WHERE post_type_id = 2 AND community_owned_date IS NULL AND closed_date IS NULL
GROUP BY 1 HAVING count(*) > 10 ORDER BY 3 DESC, 1 LIMIT 500""")
def _(t):
    return cm.top_answerers(t)


@j("J12_accept_rate", """SELECT a.owner_user_id AS id, count(*) AS answers, count(*) FILTER (q.accepted_answer_id = a.id) AS accepted, count(*) FILTER (q.accepted_answer_id = a.id) * 100.0::DOUBLE / count(*) AS accept_percent
FROM posts a JOIN posts q ON q.id = a.parent_id WHERE a.post_type_id = 2 AND q.post_type_id = 1 AND a.owner_user_id IS NOT NULL AND (q.owner_user_id IS NULL OR q.owner_user_id <> a.owner_user_id) GROUP BY 1 HAVING count(*) >= 8 ORDER BY 4 DESC, 2 DESC, 1 LIMIT 100""")
def _(t):
    return cm.accept_rate(t, 8)


@j("J13_accepted_pct", f"SELECT count(*)::DOUBLE / (SELECT count(*) FROM posts WHERE owner_user_id = {USER} AND post_type_id = 2) * 100 AS accepted_percent FROM posts q JOIN posts a ON q.accepted_answer_id = a.id WHERE a.owner_user_id = {USER} AND a.post_type_id = 2")
def _(t):
    return cm.accepted_pct(t, USER)


@j("J14_bounties_by_month", """SELECT p.*, v.bounties, v.amount FROM (SELECT year(creation_date) AS year, month(creation_date) AS month, count(*) AS questions FROM posts WHERE post_type_id = 1 GROUP BY 1, 2) p
LEFT JOIN (SELECT year(creation_date) AS year, month(creation_date) AS month, count(*) AS bounties, sum(bounty_amount)::BIGINT AS amount FROM votes WHERE vote_type_id = 9 GROUP BY 1, 2) v USING (year, month)""")
def _(t):
    return cm.bounties_by_month(t)


FAN = "FROM posts d LEFT JOIN post_history ph ON ph.post_id = d.id LEFT JOIN post_links pl ON pl.post_id = d.id LEFT JOIN posts o ON o.id = pl.related_post_id WHERE d.post_type_id = 1"


@j("J15_duplicates_by_month", f"SELECT strftime(d.creation_date, '%y-%m') AS month, count(d.id) AS cnt {FAN} AND pl.link_type_id = 3 AND ph.post_history_type_id = 10 GROUP BY 1")
def _(t):
    return cm.duplicates_by_month(t)


@j("J16_questions_by_month", f"SELECT strftime(d.creation_date, '%y-%m') AS month, count(d.id) AS cnt {FAN} GROUP BY 1")
def _(t):
    return cm.questions_by_month(t)


@j("J17_head_to_head", """SELECT m.parent_id, m.score AS my_score, r.score AS rival_score, CASE WHEN m.score > r.score THEN 'You win' WHEN m.score < r.score THEN 'Rival wins' ELSE 'Tie' END AS winner
FROM posts m JOIN posts r ON m.parent_id = r.parent_id AND r.owner_user_id % 20 = 4 WHERE m.owner_user_id % 20 = 3 AND m.post_type_id = 2 AND r.post_type_id = 2""")
def _(t):
    t.posts = t.posts.withColumn("owner_user_id", F.col("owner_user_id") % 20)
    return cm.head_to_head(t, 3, 4)


@j("J18_most_downvoted", "SELECT p.id, p.body, count(*) AS vote_count FROM votes v JOIN posts p ON p.id = v.post_id WHERE post_type_id = 1 AND vote_type_id = 3 GROUP BY 1, 2 ORDER BY 3 DESC, 1 LIMIT 20")
def _(t):
    return cm.most_downvoted(t)


@j("J19_dangerous_tags", """, x AS (SELECT pt.tag_id, count(*) FILTER (v.vote_type_id = 2) AS up, count(*) FILTER (v.vote_type_id = 3) AS dn FROM post_tags pt JOIN posts a ON a.parent_id = pt.post_id JOIN votes v ON v.post_id = a.id GROUP BY 1),
 n AS (SELECT tag_id, count(*) AS n FROM post_tags GROUP BY 1 HAVING count(*) >= 2000)
SELECT tag_name, coalesce(up, 0) AS up_votes, coalesce(dn, 0) AS down_votes, round(100.0::DOUBLE * dn / nullif(up, 0) + 1e-9, 2) AS ratio FROM n JOIN tags ON tags.id = n.tag_id LEFT JOIN x ON x.tag_id = n.tag_id""")
def _(t):
    return cm.dangerous_tags(t, 2000)


@j("J20_popular_tags", """, r AS (SELECT tag_id, count(*) AS total_posts, count(*) FILTER (creation_date BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-03-01') AS period_posts FROM post_tags JOIN posts ON posts.id = post_id GROUP BY 1)
SELECT tag_name, period_posts, total_posts, row_number() OVER (ORDER BY period_posts DESC, tag_name) AS period_rank, row_number() OVER (ORDER BY total_posts DESC, tag_name) AS total_rank FROM r JOIN tags ON tags.id = tag_id WHERE period_posts > 0 AND total_posts > 800""")
def _(t):
    return cm.popular_tags(t, b.lit_ts("1998-01-01"), b.lit_ts("1998-03-01"))


@j("J21_passive_reputation", f""", l AS (SELECT max(creation_date) AS latest FROM posts), g AS (SELECT p.id, sum(CASE WHEN vote_type_id = 2 THEN CASE WHEN parent_id IS NULL THEN 5 ELSE 10 END ELSE 0 END)::BIGINT AS up, sum(CASE WHEN vote_type_id = 3 THEN 2 ELSE 0 END)::BIGINT AS down,
 date_diff('day', p.creation_date, latest) - 15 AS days FROM votes v JOIN posts p ON p.id = v.post_id, l WHERE vote_type_id IN (2, 3) AND owner_user_id = {USER} AND community_owned_date IS NULL AND date_diff('day', p.creation_date, v.creation_date) > 15 AND date_diff('day', p.creation_date, latest) > 60 GROUP BY p.id, p.creation_date, latest)
SELECT id, up - down AS passive, up, down, days, (up - down)::DOUBLE / days AS per_day FROM g ORDER BY per_day DESC, id LIMIT 100""")
def _(t):
    return cm.passive_reputation(t, USER)


@j("J22_short_titles", "SELECT id, body, score FROM posts WHERE length(title) < 7 AND parent_id IS NULL")
def _(t):
    return cm.short_titles(t, 7)


@j("J23_thank_you_posts", "SELECT parent_id, count(*) AS answers FROM posts WHERE post_type_id = 2 AND length(body) <= 200 AND body LIKE '%e%' GROUP BY 1 HAVING count(*) > 1")
def _(t):
    return cm.thank_you_posts(t, "e")


@j("J24_quickest_badge", """SELECT b.id AS badge_id, user_id, 1 + date_diff('day', u.creation_date, b.date) AS days_membership, date_diff('day', (SELECT min(date) FROM badges WHERE name = 'signup'), b.date) AS days_since_first
FROM badges b JOIN users u ON u.id = b.user_id WHERE name = 'signup'""")
def _(t):
    return cm.quickest_badge(t, "signup")


@j("J25_rising_stars", """SELECT id, reputation, days, reputation // days AS rep_per_day FROM (SELECT *, date_diff('day', creation_date, (SELECT max(creation_date) FROM posts)) AS days FROM users) WHERE reputation > 5000 ORDER BY 4 DESC, 1 LIMIT 50""")
def _(t):
    return cm.rising_stars(t)


@j("J26_unsung_heroes", """SELECT x.*, reputation, unscored / (unscored + scored) AS ratio FROM (SELECT a.owner_user_id % 50 AS id, count(*) FILTER (a.score <> 0) AS scored, count(*) FILTER (a.score = 0) AS unscored FROM posts q JOIN posts a ON a.id = q.accepted_answer_id
 WHERE a.community_owned_date IS NULL AND a.owner_user_id IS NOT NULL AND a.owner_user_id % 50 <> coalesce(q.owner_user_id % 50, -1) GROUP BY 1 HAVING count(*) FILTER (a.score = 0) > 3) x JOIN users u ON u.id = x.id""")
def _(t):
    t.posts = t.posts.withColumn("owner_user_id", F.col("owner_user_id") % 50)
    return cm.unsung_heroes(t, 3)


@j("J27_bounty_winners", "SELECT owner_user_id, count(*) AS bounties FROM votes v JOIN posts p ON p.id = v.post_id WHERE vote_type_id = 9 GROUP BY 1 ORDER BY 2 DESC, 1 NULLS FIRST LIMIT 100")
def _(t):
    return cm.bounty_winners(t)


@j("J28_qa_by_bucket", f""", n AS (SELECT arg_max(creation_date, id) AS newest FROM posts), r AS (SELECT newest - to_days((i * 30)::INT) AS s, newest - to_days(((i - 1) * 30)::INT) AS f FROM n, range(1, 25) t(i))
SELECT {stamp('s')} AS start, count(*) FILTER (parent_id IS NULL) AS questions, count(*) FILTER (parent_id IS NOT NULL) AS answers FROM r JOIN posts ON creation_date > s AND creation_date <= f GROUP BY 1""")
def _(t):
    return cm.qa_by_bucket(t, 24)


@j("J28_qa_by_bucket_inclusive", f""", n AS (SELECT arg_max(creation_date, id) AS newest FROM posts), r AS (SELECT newest - to_days((i * 30)::INT) AS s, newest - to_days(((i - 1) * 30)::INT) AS f FROM n, range(1, 25) t(i))
SELECT {stamp('s')} AS start, count(*) FILTER (parent_id IS NULL) AS questions, count(*) FILTER (parent_id IS NOT NULL) AS answers FROM r JOIN posts ON creation_date BETWEEN s AND f GROUP BY 1""")
def _(t):
    return cm.qa_by_bucket(t, 24, inclusive=True)


@j("J29_popular_ratio", """SELECT u.id, badges, questions, badges / questions AS ratio FROM users u JOIN (SELECT user_id, count(*) AS badges FROM badges WHERE name = 'view' GROUP BY 1 HAVING count(*) >= 10) p ON p.user_id = u.id JOIN (SELECT owner_user_id, count(*) AS questions FROM posts WHERE post_type_id = 1 GROUP BY 1) q ON q.owner_user_id = u.id ORDER BY 4 DESC, 1 LIMIT 100""")
def _(t):
    return cm.popular_ratio(t, "view")


@j("J30_duplicate_accounts", """SELECT email_hash, count(*) OVER w AS accounts, row_number() OVER (PARTITION BY email_hash ORDER BY reputation DESC, id) AS position, id || ' (' || display_name || ' ' || reputation || ')' AS id_and_name FROM users WHERE email_hash IS NOT NULL
WINDOW w AS (PARTITION BY email_hash) QUALIFY count(*) OVER w > 1 AND sum(reputation) OVER w > 1000 AND count(*) FILTER (reputation > 10) OVER w > 1""")
def _(t):
    return cm.duplicate_accounts(t)


@j("J31_self_accept_rate", """, p AS (SELECT * REPLACE (owner_user_id % 30 AS owner_user_id) FROM posts) SELECT u.id, a::DOUBLE / n * 100 AS self_percent FROM users u JOIN (SELECT q.owner_user_id AS o, count(*) AS a FROM p q JOIN p a ON a.id = q.accepted_answer_id WHERE q.owner_user_id = a.owner_user_id GROUP BY 1 HAVING count(*) > 1) x ON x.o = u.id
JOIN (SELECT owner_user_id, count(*) AS n FROM p WHERE post_type_id = 1 GROUP BY 1) y ON y.owner_user_id = u.id ORDER BY 2 DESC, 1 LIMIT 100""")
def _(t):
    t.posts = t.posts.withColumn("owner_user_id", F.col("owner_user_id") % 30)
    return cm.self_accept_rate(t, 1)


@j("J32_vanity_search", f"""SELECT id, {stamp('last_activity_date')} AS last_activity_date FROM posts WHERE id IN (
 SELECT id FROM posts WHERE contains(body, 'site7.example') AND owner_user_id <> 7 AND last_activity_date BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1999-01-01'
 UNION SELECT post_id FROM comments WHERE contains(text, 'site7.example') AND user_id <> 7 AND creation_date BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1999-01-01')""")
def _(t):
    return cm.vanity_search(t, 7, b.lit_ts("1996-01-01"), b.lit_ts("1999-01-01"))


@j("J33_users_by_location", "SELECT id, display_name, location FROM users WHERE contains(location, 'NATION_1')")
def _(t):
    return cm.users_by_location(t, "NATION_1").select("id", "display_name", "location")


@j("J34_posts_by_location", """SELECT p.id AS post_id, a.display_name AS author, p.score, c.id AS comment_id, u.display_name AS commenter FROM posts p JOIN users a ON a.id = p.owner_user_id AND contains(a.location, 'NATION_1') LEFT JOIN comments c ON c.post_id = p.id LEFT JOIN users u ON u.id = c.user_id ORDER BY p.score DESC, p.id, c.id NULLS FIRST LIMIT 1000""")
def _(t):
    return cm.posts_by_location(t, "NATION_1")


@j("J35_voteless_users", "SELECT id FROM users WHERE reputation = 4 * (reputation // 4) AND id NOT IN (SELECT user_id FROM badges) AND reputation % 8 = 0")
def _(t):
    t.users = t.users.withColumn("reputation", F.col("reputation") % 8)
    return cm.voteless_users(t, 0, t.badges).select("id")


@j("J36_votes_by_month", "SELECT year(creation_date) AS year, month(creation_date) AS month, count(*) AS votes, (sum(bounty_amount) // count(bounty_amount))::BIGINT AS average_bounty FROM votes GROUP BY 1, 2")
def _(t):
    return cm.votes_by_month(t)
