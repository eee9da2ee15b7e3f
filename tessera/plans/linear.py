from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import linear as L
from tessera.plans.registry import register
from tessera.plans.sqlparts import tokens_sql
from tessera.session import scratch_path
from tessera.sources.sinks import write_instances_text, write_model, write_model_text
from tessera.sources.tables import read_instances_text, read_model_text, read_table

DIGITS = 9
EPOCHS = 2
SHARDS = 8
SEED = 42

OCC_CTE = f"""lab AS (SELECT d.doc_id, CAST(l.quality AS INTEGER) AS y, {tokens_sql('d.text')} AS t
        FROM documents d JOIN labels l ON l.doc_id = d.doc_id),
toks AS (SELECT doc_id, y, generate_subscripts(t, 1) - 1 AS pos, unnest(t) AS tok FROM lab),
feat AS (SELECT doc_id, y, CAST(pos AS INTEGER) AS pos,
                CAST(CAST(('0x' || substr(md5(tok), 1, 6)) AS BIGINT) % 1000 AS INTEGER) AS f FROM toks),
occ AS (SELECT doc_id % 3 AS model_id, doc_id, y, f, count(*) AS cnt FROM feat GROUP BY ALL)"""


def _train_sql(by_model: bool) -> str:
    """Two full-batch epochs; ``by_model`` trains one model per ``doc_id % 3``."""
    m = "model_id" if by_model else "0"
    return f"""{OCC_CTE},
w1 AS (SELECT {m} AS model_id, f, 0.002 * sum(cnt * (y - 0.5)) AS w FROM occ GROUP BY ALL),
s1 AS (SELECT o.doc_id, {('o.model_id' if by_model else '0')} AS model_id, sum(o.cnt * coalesce(w1.w, 0.0)) AS s
       FROM occ o LEFT JOIN w1 ON w1.f = o.f AND w1.model_id = {('o.model_id' if by_model else '0')} GROUP BY ALL),
g2 AS (SELECT {('o.model_id' if by_model else '0')} AS model_id, o.f,
              0.002 * sum(o.cnt * (o.y - 1.0 / (1.0 + exp(-s1.s)))) AS g
       FROM occ o JOIN s1 ON s1.doc_id = o.doc_id GROUP BY ALL),
w2 AS (SELECT coalesce(w1.model_id, g2.model_id) AS model_id, coalesce(w1.f, g2.f) AS f,
              CAST(coalesce(w1.w, 0.0) + coalesce(g2.g, 0.0) AS DOUBLE) AS w
       FROM w1 FULL JOIN g2 ON w1.f = g2.f AND w1.model_id = g2.model_id)"""


def _inst(spark, sf):
    return L.instances(read_table(spark, sf, "documents"), read_table(spark, sf, "labels"))


def _model(spark, sf):
    return L.train_fullbatch(L.occurrences(_inst(spark, sf)), EPOCHS)


def _stored_inst(spark, sf):
    """Instances that are trained on, scored and joined: tokenised once."""
    return _inst(spark, sf).checkpoint()


@register("instances", f"WITH {OCC_CTE} SELECT doc_id, y, pos, f FROM feat")
def instances(spark, sf):
    return (_inst(spark, sf).select("doc_id", "y", F.posexplode_outer("features").alias("pos", "f"))
            .where(F.col("f").isNotNull()))


@register("instances_text", f"WITH {OCC_CTE} SELECT doc_id, y, pos, f FROM feat")
def instances_text(spark, sf):
    # The test tables have no text form of instances: they are written as lines, then read back.
    path = scratch_path(spark, "instances-text")
    write_instances_text(_inst(spark, sf), path)
    rows = read_instances_text(spark, path)
    return (rows.select(F.col("doc_id").cast("long").alias("doc_id"), "y", F.posexplode_outer("features").alias("pos", "f"))
            .where(F.col("f").isNotNull()))


@register("shuffle_instances", f"""
SELECT d.doc_id, CAST(l.quality AS INTEGER) AS y, md5('{SEED}:' || d.doc_id) AS ord,
       row_number() OVER (ORDER BY md5('{SEED}:' || d.doc_id), d.doc_id) AS rank
FROM documents d JOIN labels l ON l.doc_id = d.doc_id""")
def shuffle_instances(spark, sf):
    labels = read_table(spark, sf, "labels").select("doc_id", F.col("quality").cast("int").alias("y"))
    rows = read_table(spark, sf, "documents").select("doc_id").join(labels, "doc_id")
    return L.ranked(L.shuffle_order(rows, SEED), ["ord", "doc_id"])


@register("train_fullbatch", f"WITH {_train_sql(False)} SELECT f, round(w, {DIGITS}) AS w FROM w2")
def train_fullbatch(spark, sf):
    return _model(spark, sf).select("f", F.round("w", DIGITS).alias("w"))


# Each shard's steps in the seeded order, one instance a step, over weights and counts as lists of 1000.
SHARDED_SQL = f"""WITH RECURSIVE {OCC_CTE},
inst AS (SELECT DISTINCT doc_id, y, md5('{SEED}:' || doc_id) AS ord FROM lab),
placed AS (SELECT *, CAST(CAST(('0x' || substr(ord, 1, 8)) AS BIGINT) % {SHARDS} AS INTEGER) AS shard FROM inst),
counts AS (SELECT p.doc_id, list(CAST(coalesce(o.cnt, 0) AS DOUBLE) ORDER BY g.f) AS c
           FROM placed p CROSS JOIN (SELECT CAST(unnest(range(1000)) AS INTEGER) AS f) g
           LEFT JOIN occ o ON o.doc_id = p.doc_id AND o.f = g.f GROUP BY p.doc_id),
steps AS (SELECT p.shard, p.y, c.c, row_number() OVER (PARTITION BY p.shard ORDER BY p.ord, p.doc_id) AS k
          FROM placed p JOIN counts c ON c.doc_id = p.doc_id),
replay AS (
  SELECT DISTINCT shard, CAST(0 AS BIGINT) AS k, list_transform(range(1000), lambda i: CAST(0 AS DOUBLE)) AS w FROM placed
  UNION ALL
  SELECT shard, k, list_transform(list_zip(w, c), lambda z: z[1] + g * z[2]) FROM (
    SELECT s.shard, s.k, r.w, s.c, 0.002 * (s.y - 1.0 / (1.0 + exp(-list_dot_product(r.w, s.c)))) AS g
    FROM replay r JOIN steps s ON s.shard = r.shard AND s.k = r.k + 1)),
done AS (SELECT shard, max_by(w, k) AS w FROM replay GROUP BY shard),
held AS (SELECT generate_subscripts(w, 1) - 1 AS f, unnest(w) AS w FROM done)
SELECT CAST(f AS INTEGER) AS f, round(sum(w) / {SHARDS}, {DIGITS}) AS w FROM held
WHERE f IN (SELECT f FROM feat) GROUP BY f"""


@register("train_sharded", SHARDED_SQL)
def train_sharded(spark, sf):
    return L.train_sharded(_inst(spark, sf), SHARDS, seed=SEED).select("f", F.round("w", DIGITS).alias("w"))


SCORE_SQL = f"""WITH {_train_sql(False)},
sc AS (SELECT o.doc_id, sum(o.cnt * w2.w) AS s FROM occ o JOIN w2 ON w2.f = o.f GROUP BY o.doc_id),
docs AS (SELECT DISTINCT doc_id, y FROM lab)
SELECT d.doc_id, d.y, round(coalesce(sc.s, 0.0), {DIGITS}) AS score,
       CASE WHEN coalesce(sc.s, 0.0) < 0 THEN 'ham' ELSE 'spam' END AS predicted
FROM docs d LEFT JOIN sc ON sc.doc_id = d.doc_id"""


@register("score_documents", SCORE_SQL)
def score_documents(spark, sf):
    inst = _stored_inst(spark, sf)
    model = L.train_fullbatch(L.occurrences(inst), EPOCHS)
    return L.score_documents(inst, model).withColumn("score", F.round("score", DIGITS))


@register("model_text_read", f"WITH {_train_sql(False)} SELECT f, round(w, {DIGITS}) AS w FROM w2")
def model_text_read(spark, sf):
    path = scratch_path(spark, "model-text")
    write_model_text(_model(spark, sf), path)
    return read_model_text(spark, path).select("f", F.round("w", DIGITS).alias("w"))


@register("model_partitions", f"WITH {_train_sql(True)} SELECT f, round(w, {DIGITS}) AS w FROM w2 WHERE model_id = 1")
def model_partitions(spark, sf):
    # Three models stored by model, of which one is read.
    occ = L.occurrences(_inst(spark, sf).withColumn("model_key", F.col("doc_id") % 3), "model_key")
    path = scratch_path(spark, "models")
    write_model(L.train_fullbatch(occ, EPOCHS), path)
    return spark.read.parquet(path).where("model_id = 1").select("f", F.round("w", DIGITS).alias("w"))


ENSEMBLE_CTE = f"""{_train_sql(True)},
sc AS (SELECT w2.model_id, o.doc_id, sum(o.cnt * w2.w) AS s FROM occ o JOIN w2 ON w2.f = o.f GROUP BY ALL),
docs AS (SELECT DISTINCT doc_id, y FROM lab),
agg AS (SELECT doc_id, sum(s) AS total, count(*) FILTER (WHERE s > 0) AS n_pos FROM sc GROUP BY doc_id)"""


@register("ensemble_average", f"""WITH {ENSEMBLE_CTE}
SELECT d.doc_id, d.y, round(coalesce(a.total, 0.0) / 3.0, {DIGITS}) AS score,
       CASE WHEN coalesce(a.total, 0.0) / 3.0 > 0 THEN 'spam' ELSE 'ham' END AS predicted
FROM docs d LEFT JOIN agg a ON a.doc_id = d.doc_id""")
def ensemble_average(spark, sf):
    return _ensemble(spark, sf, "average").withColumn("score", F.round("score", DIGITS))


@register("ensemble_vote", f"""WITH {ENSEMBLE_CTE}
SELECT d.doc_id, d.y, CAST(2 * coalesce(a.n_pos, 0) - 3 AS INTEGER) AS score,
       CASE WHEN 2 * coalesce(a.n_pos, 0) - 3 > 0 THEN 'spam' ELSE 'ham' END AS predicted
FROM docs d LEFT JOIN agg a ON a.doc_id = d.doc_id""")
def ensemble_vote(spark, sf):
    return _ensemble(spark, sf, "vote")


def _ensemble(spark, sf, method):
    # Three models trained in one job, one per document third (doc_id % 3).
    inst = _stored_inst(spark, sf)
    occ = L.occurrences(inst.withColumn("model_key", F.col("doc_id") % 3), "model_key")
    models = L.train_fullbatch(occ, EPOCHS)
    return L.ensemble(inst, models, method, 3)
