"""The same results in plain SQL over the same tables, written from the definitions."""

from __future__ import annotations

from checks.inputs import SPLIT_DAY, STOPWORDS
from checks.queries import ITEM_FAMILY, USER_FAMILY
from kindred.operators.minhash import PRIME

_WORDS = ", ".join(f"'{w}'" for w in STOPWORDS)


def _family(name: str, family: list[tuple[int, int]]) -> str:
    rows = ", ".join(f"({i}, {a}::BIGINT, {b}::BIGINT)" for i, (a, b) in enumerate(family))
    return f"{name}(pos, a, b) AS (VALUES {rows})"


def _latest(name: str, source: str) -> str:
    return f"""{name} AS (
  SELECT user_id, business_id, stars FROM (
    SELECT *, row_number() OVER (
      PARTITION BY user_id, business_id
      ORDER BY l_orderkey DESC, l_linenumber DESC, l_shipdate DESC, stars DESC) AS rn
    FROM {source})
  WHERE rn = 1)"""


def _moments(name: str, source: str, entity: str, element: str) -> str:
    return f"""{name} AS (
  SELECT x.{entity} AS a, y.{entity} AS b, count(*) AS n,
         sum(x.stars) AS sx, sum(y.stars) AS sy,
         sum(x.stars * x.stars) AS sxx, sum(y.stars * y.stars) AS syy, sum(x.stars * y.stars) AS sxy
  FROM {source} x JOIN {source} y ON x.{element} = y.{element} AND x.{entity} < y.{entity}
  GROUP BY ALL HAVING count(*) >= 3)"""


def _pearson(name: str, source: str) -> str:
    top, vx, vy = "(n * sxy - sx * sy)", "(n * sxx - sx * sx)", "(n * syy - sy * sy)"
    return f"""{name} AS (
  SELECT a, b, n, CASE WHEN {top} > 0 AND {vx} > 0 AND {vy} > 0
    THEN round({top} / (sqrt({vx}) * sqrt({vy})), 9) ELSE 0.0 END AS sim
  FROM {source})"""


def _signatures(name: str, entity: str, element: str, family: str, bucketed: bool = True) -> str:
    last = f" % (SELECT greatest(count(DISTINCT {element}) - 1, 1) FROM ratings)" if bucketed else ""
    return f"""{name} AS (
  SELECT m.{entity}, f.pos, min(((f.a * i.idx + f.b) % {PRIME}){last}) AS value
  FROM (SELECT DISTINCT {entity}, {element} FROM ratings) m
  JOIN (SELECT {element}, row_number() OVER (ORDER BY {element}) - 1 AS idx
        FROM (SELECT DISTINCT {element} FROM ratings)) i USING ({element})
  CROSS JOIN {family} f
  GROUP BY ALL)"""


def _meetings(name: str, signatures: str, entity: str, rows: int = 1) -> str:
    """Bucket members paired up, one row per pair with the number of bands they share."""
    return f"""{name}_bands AS (
  SELECT {entity}, pos // {rows} AS band, list(value ORDER BY pos) AS bucket FROM {signatures} GROUP BY ALL),
{name} AS (
  SELECT x.{entity} AS a, y.{entity} AS b, count(*) AS n_bands
  FROM {name}_bands x JOIN {name}_bands y
    ON x.band = y.band AND x.bucket = y.bucket AND x.{entity} < y.{entity}
  GROUP BY ALL)"""


def _groups(rows: int) -> str:
    return f""", entries AS (
  SELECT CAST(pos // {rows} AS INTEGER) AS band, string_agg(value::VARCHAR, ',' ORDER BY pos) AS bucket, business_id
  FROM sig GROUP BY ALL)
SELECT band, bucket, business_id, n_members FROM entries
JOIN (SELECT band, bucket, count(*) AS n_members FROM entries GROUP BY ALL HAVING count(*) > 1) USING (band, bucket)"""


RATINGS = f"""ratings AS (
  SELECT o_custkey AS user_id, l_partkey AS business_id,
         CAST(1 + CAST(l_quantity AS INTEGER) % 5 AS DOUBLE) AS stars,
         l_orderkey, l_linenumber, l_shipdate, o_orderdate >= TIMESTAMP '{SPLIT_DAY}' AS is_test
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
SPLIT = """train AS (SELECT * FROM ratings WHERE NOT is_test),
test AS (SELECT user_id, business_id, stars FROM ratings WHERE is_test)"""
MEMBERS = "members AS (SELECT DISTINCT business_id, user_id FROM ratings)"
OVERLAPS = """sizes AS (SELECT business_id, count(*) AS size FROM members GROUP BY ALL),
commons AS (
  SELECT x.business_id AS a, y.business_id AS b, count(*) AS n
  FROM members x JOIN members y ON x.user_id = y.user_id AND x.business_id < y.business_id
  GROUP BY ALL),
jaccards AS (
  SELECT a, b, n, s.size + t.size - n AS n_union, n / (s.size + t.size - n) AS jaccard
  FROM commons JOIN sizes s ON s.business_id = a JOIN sizes t ON t.business_id = b)"""
_SETS = f"WITH {RATINGS}, {MEMBERS}"
_OVER = f"{_SETS}, {OVERLAPS}"
_LATEST = f"WITH {RATINGS}, {_latest('latest', 'ratings')}"
_MOMENTS = f"{_LATEST}, {_moments('moments', 'latest', 'business_id', 'user_id')}"
_SIG = f"{_SETS}, {_family('fam', ITEM_FAMILY)}, {_signatures('sig', 'business_id', 'user_id', 'fam')}"
_EXACT = "SELECT a AS b1, b AS b2, round(jaccard, 9) AS sim FROM jaccards WHERE jaccard >= 0.05"
_FOUND = f"{_SIG}, {OVERLAPS}, {_meetings('met', 'sig', 'business_id')}"

_TRAIN = f"WITH {RATINGS}, {SPLIT}, {_latest('latest', 'train')}"
_ITEM_MODEL = f"""{_TRAIN}, {_moments('moments', 'latest', 'business_id', 'user_id')}, {_pearson('sims', 'moments')},
model AS (SELECT a AS k1, b AS k2, sim FROM sims WHERE sim > 0)"""


def _user_model(source: str) -> str:
    return f"""{_moments('moments', source, 'user_id', 'business_id')}, {_pearson('sims', 'moments')},
held AS (SELECT user_id, count(*) AS size FROM {source} GROUP BY ALL),
model AS (
  SELECT a AS k1, b AS k2, sim FROM sims JOIN held s ON s.user_id = a JOIN held t ON t.user_id = b
  WHERE sim > 0 AND n / (s.size + t.size - n) >= 0.01)"""


_USER_MODEL = f"{_TRAIN}, {_user_model('latest')}"
_BOTH = "sides AS (SELECT k1 AS me, k2 AS nbr, sim FROM model UNION ALL SELECT k2, k1, sim FROM model)"
_ITEM_PREDICT = f"""{_ITEM_MODEL}, {_BOTH},
known AS (SELECT DISTINCT user_id, business_id, stars FROM train),
wanted AS (SELECT DISTINCT user_id, business_id FROM test),
near AS (
  SELECT w.user_id, w.business_id, k.stars, s.sim,
         row_number() OVER (PARTITION BY w.user_id, w.business_id ORDER BY s.sim DESC, s.nbr, k.stars) AS rn
  FROM wanted w JOIN known k ON k.user_id = w.user_id
  JOIN sides s ON s.me = w.business_id AND s.nbr = k.business_id),
sums AS (
  SELECT user_id, business_id, round(sum(stars * sim), 9) AS top, round(sum(abs(sim)), 9) AS weight
  FROM near WHERE rn <= 5 GROUP BY ALL),
predicted AS (SELECT user_id, business_id, top / weight AS stars FROM sums WHERE top <> 0 AND weight <> 0),
predictions AS (SELECT user_id, business_id, p.stars FROM test JOIN predicted p USING (user_id, business_id))"""
_USER_PREDICT = f"""{_USER_MODEL}, {_BOTH},
known AS (SELECT DISTINCT user_id, business_id, stars FROM train),
stats AS (SELECT user_id, sum(stars) AS total, count(*) AS n, avg(stars) AS mean FROM train GROUP BY ALL),
wanted AS (SELECT DISTINCT user_id, business_id FROM test),
near AS (
  SELECT w.user_id, w.business_id, s.nbr, k.stars, s.sim,
         row_number() OVER (PARTITION BY w.user_id, w.business_id ORDER BY s.sim DESC, s.nbr, k.stars) AS rn
  FROM wanted w JOIN known k ON k.business_id = w.business_id
  JOIN sides s ON s.me = w.user_id AND s.nbr = k.user_id),
deviations AS (
  SELECT near.user_id, near.business_id, sim,
         near.stars - CASE WHEN v.n > 1 THEN (v.total - own.stars) / (v.n - 1) ELSE v.mean END AS deviation
  FROM near JOIN stats v ON v.user_id = nbr
  JOIN latest own ON own.user_id = nbr AND own.business_id = near.business_id
  WHERE rn <= 20),
sums AS (
  SELECT user_id, business_id, round(sum(deviation * sim), 9) AS top, round(sum(abs(sim)), 9) AS weight
  FROM deviations GROUP BY ALL),
predicted AS (
  SELECT user_id, business_id, mean + top / weight AS stars FROM sums JOIN stats USING (user_id)
  WHERE top <> 0 AND weight <> 0),
predictions AS (
  SELECT user_id, business_id, p.stars FROM test JOIN predicted p USING (user_id, business_id) WHERE p.stars <> 0)"""
_RMSE = """
SELECT (SELECT count(*) FROM test)::BIGINT AS n_truth, count(*) AS n_predicted,
       round(sqrt(avg((p.stars - t.stars) * (p.stars - t.stars))), 6) AS rmse
FROM test t JOIN predicted p USING (user_id, business_id)"""

REVIEWS = "reviews AS (SELECT doc_id * 31 % 203 AS user_id, doc_id % 97 AS business_id, text FROM documents)"
_TOKENS = rf"""WITH {REVIEWS},
tokens AS (
  SELECT business_id, word FROM (
    SELECT business_id, unnest(string_split(regexp_replace(lower(text), '[^\p{{L}} ]', '', 'g'), ' ')) AS word
    FROM reviews)
  WHERE word <> '' AND word NOT IN ({_WORDS}))"""
_COUNTS = f"""{_TOKENS},
counts AS (SELECT business_id, word, count(*) AS n FROM tokens GROUP BY ALL)"""
_TF = f"""{_COUNTS},
tf AS (SELECT business_id, word, n / max(n) OVER (PARTITION BY business_id) AS tf FROM counts)"""
_IDF = """idf AS (
  SELECT word, count(*) AS df, log2((SELECT count(DISTINCT business_id) FROM reviews) / count(*)) AS idf
  FROM counts GROUP BY word)"""
_TFIDF = f"""{_TF}, {_IDF},
tfidf AS (SELECT business_id, word, round(tf * idf, 9) AS tfidf FROM tf JOIN idf USING (word))"""
_PROFILES = f"""{_TFIDF},
biz AS (
  SELECT * FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY business_id ORDER BY tfidf DESC, word) AS INTEGER) AS rank FROM tfidf)
  WHERE rank <= 200),
usr AS (
  SELECT * FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY tfidf DESC, word) AS INTEGER) AS rank FROM (
      SELECT user_id, word, max(tfidf) AS tfidf
      FROM (SELECT DISTINCT user_id, business_id FROM reviews) JOIN biz USING (business_id) GROUP BY ALL))
  WHERE rank <= 500)"""
_SCORES = f"""{_PROFILES},
targets AS (SELECT DISTINCT user_id, (business_id + 5) % 97 AS business_id FROM reviews),
usizes AS (SELECT user_id, count(*) AS nu FROM usr GROUP BY ALL),
bsizes AS (SELECT business_id, count(*) AS nb FROM biz GROUP BY ALL),
shared AS (
  SELECT t.user_id, t.business_id, count(*) AS n
  FROM targets t JOIN usr u ON u.user_id = t.user_id JOIN biz b ON b.business_id = t.business_id AND b.word = u.word
  GROUP BY ALL),
scores AS (
  SELECT t.user_id, t.business_id, coalesce(round(n / (sqrt(nu) * sqrt(nb)), 9), 0.0) AS sim
  FROM targets t LEFT JOIN shared USING (user_id, business_id)
  LEFT JOIN usizes USING (user_id) LEFT JOIN bsizes USING (business_id))"""

ORACLE: dict[str, str] = {
    "entity_sets": f"{_SETS} SELECT business_id, user_id FROM members",
    "cooccurrence_pairs": f"{_OVER} SELECT a AS b1, b AS b2, n FROM commons WHERE n >= 3",
    "jaccard_pairs": f"""{_OVER} SELECT a AS b1, b AS b2, n AS n_intersection, n_union, round(jaccard, 9) AS sim
FROM jaccards WHERE n >= 3""",
    "similar_pairs_exact": f"{_OVER} {_EXACT}",
    "dedup_ratings": f"{_LATEST} SELECT user_id, business_id, stars FROM latest",
    "distinct_user_ratings": f"WITH {RATINGS} SELECT DISTINCT user_id, business_id, stars FROM ratings",
    "user_rating_stats": f"""WITH {RATINGS} SELECT user_id, sum(stars) AS sum_stars, count(*) AS n_ratings,
  round(avg(stars), 6) AS mean_stars FROM ratings GROUP BY ALL""",
    "min_support_items": f"""WITH {RATINGS} SELECT business_id, count(*) AS n_ratings FROM ratings
GROUP BY ALL HAVING count(*) >= 3""",
    "supported_ratings": f"""{_LATEST} SELECT business_id, user_id, stars FROM latest
WHERE business_id IN (SELECT business_id FROM ratings GROUP BY ALL HAVING count(*) >= 30)""",
    "pair_moments": f"{_MOMENTS} SELECT a AS b1, b AS b2, n, sx, sy, sxx, syy, sxy FROM moments",
    "pearson_pairs": f"""{_MOMENTS}, {_pearson('sims', 'moments')}
SELECT a AS b1, b AS b2, n, sim FROM sims""",
    "encode_ids": f"""WITH {RATINGS} SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS idx
FROM (SELECT DISTINCT user_id FROM ratings)""",
    "minhash_signatures": f"{_SIG} SELECT business_id, CAST(pos AS INTEGER) AS pos, value FROM sig",
    "lsh_candidates": f"{_SIG} {_groups(1)}",
    "lsh_candidates_banded": f"{_SIG} {_groups(2)}",
    "lsh_stats": f"""{_SIG}, counts AS (SELECT CAST(pos AS INTEGER) AS band, value, count(*) AS n FROM sig GROUP BY ALL)
SELECT band, sum(n)::BIGINT AS n_entities, count(*) AS n_buckets, count(*) FILTER (n = 1) AS n_single,
  max(n) AS largest_bucket, sum(n * (n - 1) // 2)::BIGINT AS n_pairs FROM counts GROUP BY band""",
    "lsh_candidate_pairs": f"""{_FOUND}
SELECT a AS b1, b AS b2, coalesce(n, 0) AS n, CAST(n_bands AS INTEGER) AS n_bands FROM met LEFT JOIN commons USING (a, b)""",
    "similar_pairs_lsh": f"{_FOUND} {_EXACT} AND (a, b) IN (SELECT (a, b) FROM met)",
    "similar_pairs_lsh_banded": f"""{_SETS}, {_family('fam', ITEM_FAMILY)},
{_signatures('sig', 'business_id', 'user_id', 'fam', bucketed=False)}, {OVERLAPS},
{_meetings('met', 'sig', 'business_id', 2)} {_EXACT} AND (a, b) IN (SELECT (a, b) FROM met)""",
    "lsh_precision_recall": f"""{_FOUND}, truth AS (SELECT a, b FROM jaccards WHERE jaccard >= 0.05),
found AS (SELECT a, b FROM truth JOIN met USING (a, b)),
counted AS (
  SELECT (SELECT count(*) FROM found) AS n_found, (SELECT count(*) FROM truth) AS n_truth,
         (SELECT count(*) FROM found JOIN truth USING (a, b)) AS n_hits)
SELECT *, round(n_hits / n_found, 6) AS precision, round(n_hits / n_truth, 6) AS recall FROM counted""",
    "user_cf_model_lsh": f"""{_LATEST}, {_family('fam', USER_FAMILY)},
{_signatures('sig', 'user_id', 'business_id', 'fam')}, {_meetings('met', 'sig', 'user_id')}, {_user_model('latest')}
SELECT k1 AS u1, k2 AS u2, sim FROM model JOIN met ON a = k1 AND b = k2""",
    "item_cf_model": f"{_MOMENTS}, {_pearson('sims', 'moments')} SELECT a AS b1, b AS b2, sim FROM sims WHERE sim > 0",
    "user_cf_model_exact": f"{_LATEST}, {_user_model('latest')} SELECT k1 AS u1, k2 AS u2, sim FROM model",
    "item_cf_predict": f"{_ITEM_PREDICT} SELECT user_id, business_id, round(stars, 6) AS stars FROM predictions",
    "user_cf_predict": f"{_USER_PREDICT} SELECT user_id, business_id, round(stars, 6) AS stars FROM predictions",
    "item_cf_rmse": f"{_ITEM_PREDICT} {_RMSE}",
    "user_cf_rmse": f"{_USER_PREDICT} {_RMSE}",
    "review_tokens": f"""{_TOKENS} SELECT business_id, count(*) AS n_tokens, sum(length(word))::BIGINT AS n_letters
FROM tokens GROUP BY ALL""",
    "word_counts": f"{_COUNTS} SELECT business_id, word, n FROM counts",
    "term_frequency": f"{_TF} SELECT business_id, word, round(tf, 6) AS tf FROM tf",
    "idf": f"{_COUNTS}, {_IDF} SELECT word, df, round(idf, 6) AS idf FROM idf",
    "tfidf": f"{_TFIDF} SELECT business_id, word, tfidf FROM tfidf",
    "business_profiles": f"{_PROFILES} SELECT business_id, word, tfidf, rank FROM biz",
    "user_profiles": f"{_PROFILES} SELECT user_id, word, tfidf, rank FROM usr",
    "content_model_union": f"""{_PROFILES}
SELECT 'biz' AS type, business_id AS biz_id, NULL::BIGINT AS user_id, rank - 1 AS pos, word FROM biz
UNION ALL SELECT 'user', NULL::BIGINT, user_id, rank - 1, word FROM usr""",
    "content_scores": f"{_SCORES} SELECT user_id, business_id, sim FROM scores",
    "content_predict": f"{_SCORES} SELECT user_id, business_id, sim FROM scores WHERE sim >= 0.01",
}
ORACLE |= {
    "similar_pairs_hot": ORACLE["similar_pairs_exact"],
    "cooccurrence_pairs_hot": ORACLE["cooccurrence_pairs"],
    "pair_moments_hot": ORACLE["pair_moments"],
    "user_cf_model_lsh_banded": f"""{_LATEST}, {_family('fam', USER_FAMILY)},
{_signatures('sig', 'user_id', 'business_id', 'fam', bucketed=False)}, {_meetings('met', 'sig', 'user_id', 2)}, {_user_model('latest')}
SELECT k1 AS u1, k2 AS u2, sim FROM model JOIN met ON a = k1 AND b = k2""",
    "item_cf_predict_ranked": ORACLE["item_cf_predict"],
    "user_cf_predict_ranked": ORACLE["user_cf_predict"],
}
