"""Checked queries on dense vectors. The queries are the mean vectors of the labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselight.functions import vectors as vx
from caselight.operators import dense, evaluation, hits
from caselight.plans.indexes import stored_table
from caselight.registry import query, table

PLANES = 4
DIMENSIONS = 64

_BASE = """
v AS (SELECT vec_id AS id, label, embedding::DOUBLE[] AS vec FROM embeddings),
dims AS (SELECT id, label, unnest(vec) AS x, unnest(generate_series(1, len(vec))) AS d FROM v),
stats AS (SELECT label, d, avg(x) AS mean, min(x) AS lo, max(x) AS hi FROM dims GROUP BY ALL),
centre AS (
  SELECT label, list(mean ORDER BY d) AS mean, list((lo + hi) / 2 ORDER BY d) AS middle, list(hi ORDER BY d) AS top
  FROM stats GROUP BY label)"""
_KEY = "floor(score * 1e9 + 0.5)"
_SCORED = """
scored AS (
  SELECT c.label::VARCHAR AS query_id, v.id, v.label, list_cosine_similarity(c.mean, v.vec) AS score
  FROM centre c, v)"""


def _ranked(k: str, source: str = "scored", name: str = "hits", where: str = "true") -> str:
    return f"""
{name} AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY {_KEY} DESC, id) AS rank
  FROM {source} WHERE {where} QUALIFY rank <= {k})"""


def corpus(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), F.col("label").alias("category")
    )


def label_queries(spark, sf_dir, variant: str = "mean") -> DataFrame:
    """One query per label, with the label as its category."""
    centres = dense.centroids(corpus(spark, sf_dir))
    return centres.select(
        F.col("category").cast("string").alias("query_id"), F.col(variant).alias("vector"), "category"
    )


def _with_centre(spark, sf_dir) -> DataFrame:
    """Each vector next to the mean of its own label."""
    centres = dense.centroids(corpus(spark, sf_dir)).select("category", "mean")
    return corpus(spark, sf_dir).join(centres, "category")


_OWN = f"WITH {_BASE}, own AS (SELECT v.id, v.vec, c.mean FROM v JOIN centre c USING (label))"
_UNIT = "list_transform({x}, lambda e: e / sqrt(list_sum(list_transform({x}, lambda f: f * f))))"


@query(
    "vector_normalize",
    f"""WITH {_BASE}, unit AS (SELECT id, sqrt(list_sum(list_transform(vec, lambda f: f * f))) AS norm,
        vec FROM v)
      SELECT id, round(vec[1] / norm, 6) AS first, round(vec[64] / norm, 6) AS last, round(norm, 6) AS norm FROM unit""",
)
def vector_normalize(spark, sf_dir):
    unit = corpus(spark, sf_dir).withColumn("unit", vx.normalize(F.col("vector")))
    return unit.select(
        "id",
        F.round(F.element_at("unit", 1), 6).alias("first"),
        F.round(F.element_at("unit", -1), 6).alias("last"),
        F.round(vx.l2_norm(F.col("vector")), 6).alias("norm"),
    )


@query("cosine_pairs", f"{_OWN} SELECT id, round(list_cosine_similarity(vec, mean), 6) AS cosine FROM own")
def cosine_pairs(spark, sf_dir):
    return _with_centre(spark, sf_dir).select(
        "id", F.round(vx.cosine(F.col("vector"), F.col("mean")), 6).alias("cosine")
    )


_UNIT_OWN = f"""{_OWN}, unit AS (SELECT id, list_distance({_UNIT.format(x='vec')}, {_UNIT.format(x='mean')}) ** 2 AS d
  FROM own)"""


def _unit_distance() -> F:
    return vx.squared_l2(vx.normalize(F.col("vector")), vx.normalize(F.col("mean")))


@query(
    "l2_to_cosine",
    f"{_UNIT_OWN} SELECT id, round(d, 6) AS squared_l2, round(1 - d / 2, 6) AS cosine FROM unit",
)
def l2_to_cosine(spark, sf_dir):
    measured = _with_centre(spark, sf_dir).select("id", _unit_distance().alias("d"))
    return measured.select(
        "id", F.round("d", 6).alias("squared_l2"),
        F.round(vx.cosine_from_squared_l2(F.col("d")), 6).alias("cosine"),
    )


@query(
    "angular_distance",
    f"{_OWN} SELECT id, round(sqrt(2 * (1 - list_cosine_similarity(vec, mean))), 6) AS angular FROM own",
)
def angular_distance(spark, sf_dir):
    cos = vx.cosine(F.col("vector"), F.col("mean"))
    return _with_centre(spark, sf_dir).select("id", F.round(vx.angular_distance(cos), 6).alias("angular"))


@query(
    "distance_score",
    f"""{_OWN} SELECT id, round(list_distance(vec, mean), 6) AS distance,
      round(1 / (1 + list_distance(vec, mean)), 6) AS score FROM own""",
)
def distance_score(spark, sf_dir):
    measured = _with_centre(spark, sf_dir).select(
        "id", F.sqrt(vx.squared_l2(F.col("vector"), F.col("mean"))).alias("d")
    )
    return measured.select(
        "id", F.round("d", 6).alias("distance"), F.round(vx.closeness(F.col("d")), 6).alias("score")
    ).orderBy("distance", "id")


@query(
    "similarity_matrix",
    f"""WITH {_BASE} SELECT a.label AS a, b.label AS b, round(list_cosine_similarity(a.mean, b.mean), 6) AS cosine
      FROM centre a JOIN centre b ON a.label < b.label""",
)
def similarity_matrix(spark, sf_dir):
    """Between the mean vectors of the labels, which are few whatever the table holds."""
    centres = dense.centroids(corpus(spark, sf_dir))
    pairs = dense.similarity_matrix(centres, "category", "mean")
    return pairs.select("a", "b", F.round("cosine", 6).alias("cosine"))


def _shown(found: DataFrame) -> DataFrame:
    return found.select("query_id", "id", F.round("score", 6).alias("score"), "rank")


@query(
    "vector_topk",
    f"WITH {_BASE}, {_SCORED}, {_ranked('10')} SELECT query_id, id, round(score, 6) AS score, rank FROM hits",
)
def vector_topk(spark, sf_dir):
    return _shown(dense.cosine_top_k(label_queries(spark, sf_dir), corpus(spark, sf_dir), 10))


@query(
    "vector_topk_filtered",
    f"""WITH {_BASE}, {_SCORED}, {_ranked('5', where='query_id = label::VARCHAR')}
      SELECT query_id, id, round(score, 6) AS score, rank FROM hits""",
)
def vector_topk_filtered(spark, sf_dir):
    return _shown(
        dense.cosine_top_k(label_queries(spark, sf_dir), corpus(spark, sf_dir), 5, by_category=True)
    )


@query(
    "variable_topk",
    f"""WITH {_BASE}, {_SCORED}, {_ranked("CASE WHEN query_id IN ('2', '4') THEN 6 ELSE 3 END")}
      SELECT query_id, id, round(score, 6) AS score, rank FROM hits""",
)
def variable_topk(spark, sf_dir):
    """Three hits, or six for two of the query types."""
    wide = F.when(F.col("query_id").isin("2", "4"), 6).otherwise(3)
    found = dense.cosine_top_k(label_queries(spark, sf_dir), corpus(spark, sf_dir), 6)
    return _shown(found.filter(F.col("rank") <= wide))


@query(
    "two_stage_rerank",
    f"""WITH {_BASE}, {_SCORED}, {_ranked('5', name='first_stage')},
      second AS (SELECT f.query_id, f.id, f.score AS first_score, list_cosine_similarity(c.top, v.vec) AS score
        FROM first_stage f JOIN centre c ON c.label::VARCHAR = f.query_id JOIN v USING (id)),
      {_ranked('3', source='second')}
      SELECT query_id, id, round(first_score, 6) AS first_score, round(score, 6) AS score, rank FROM hits""",
)
def two_stage_rerank(spark, sf_dir):
    """Five candidates by the mean vector of a label, three kept by its highest values."""
    vectors = corpus(spark, sf_dir)
    first = dense.cosine_top_k(label_queries(spark, sf_dir), vectors, 5)
    detail = label_queries(spark, sf_dir, "max").select("query_id", F.col("vector").alias("detail"))
    candidates = first.join(vectors.select("id", "vector"), "id").join(detail, "query_id")
    kept = dense.rerank(candidates, vx.cosine(F.col("detail"), F.col("vector")), 3)
    return kept.select(
        "query_id", "id", F.round("first_score", 6).alias("first_score"), F.round("score", 6).alias("score"), "rank"
    )


_VARIANTS = f"""
variants AS (
  SELECT label::VARCHAR AS query_id, 0 AS variant, mean AS vec FROM centre
  UNION ALL SELECT label::VARCHAR, 1, middle FROM centre UNION ALL SELECT label::VARCHAR, 2, top FROM centre),
variant_scored AS (
  SELECT q.query_id, variant, v.id, v.label, list_cosine_similarity(q.vec, v.vec) AS score FROM variants q, v),
variant_hits AS (
  SELECT *, sqrt(greatest(2 * (1 - score), 0)) AS distance FROM variant_scored
  QUALIFY row_number() OVER (PARTITION BY query_id, variant ORDER BY {_KEY} DESC, id) <= 5),
best AS (
  SELECT *, id // 5 AS key FROM variant_hits
  QUALIFY row_number() OVER (PARTITION BY query_id, id // 5 ORDER BY floor(distance * 1e9 + 0.5), id) = 1),
merged AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY floor(distance * 1e9 + 0.5), id) AS rank FROM best
  QUALIFY rank <= 5)"""


def _variant_hits(spark, sf_dir) -> DataFrame:
    """Five hits of each of three variants of a query; five neighbouring ids are one product."""
    vectors, parts = corpus(spark, sf_dir), None
    for number, variant in enumerate(("mean", "middle", "max")):
        asked = label_queries(spark, sf_dir, variant).withColumn(
            "query_id", F.concat_ws("/", "query_id", F.lit(str(number)))
        )
        parts = asked if parts is None else parts.unionByName(asked)
    found = dense.cosine_top_k(parts, vectors, 5)
    return found.select(
        F.split_part("query_id", F.lit("/"), F.lit(1)).alias("query_id"),
        F.floor(F.col("id") / 5).alias("key"),
        "id",
        vx.angular_distance(F.col("score")).alias("distance"),
    )


@query(
    "multi_query_merge",
    f"WITH {_BASE}, {_VARIANTS} SELECT query_id, key, id, round(distance, 6) AS distance, rank FROM merged",
)
def multi_query_merge(spark, sf_dir):
    merged = dense.merge_variants(_variant_hits(spark, sf_dir), 5)
    return merged.select("query_id", "key", "id", F.round("distance", 6).alias("distance"), "rank")


@query(
    "coverage_at_k",
    f"""WITH {_BASE}, {_SCORED}, {_ranked('5')}, {_VARIANTS},
      before AS (SELECT query_id, count(DISTINCT label) AS n FROM hits GROUP BY query_id),
      after AS (SELECT query_id, count(DISTINCT label) AS n FROM merged GROUP BY query_id)
      SELECT query_id, b.n AS before_expansion, a.n AS after_expansion FROM before b JOIN after a USING (query_id)""",
)
def coverage_at_k(spark, sf_dir):
    """Distinct labels among the first five, with one query and with its variants merged."""
    vectors = corpus(spark, sf_dir)
    single = dense.cosine_top_k(label_queries(spark, sf_dir), vectors, 5)
    merged = dense.merge_variants(_variant_hits(spark, sf_dir), 5)
    return evaluation.coverage(single, merged, vectors.select("id", "category"))


_REUSE = 1.2


@query(
    "semantic_reuse",
    f"""WITH v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS vec FROM embeddings),
      pairs AS (SELECT a.id, b.id AS match_id, list_distance(a.vec, b.vec) AS distance
        FROM v a JOIN v b ON b.id < a.id)
      SELECT id, match_id, round(distance, 6) AS distance FROM pairs WHERE distance <= {_REUSE}
      QUALIFY row_number() OVER (PARTITION BY id ORDER BY floor(distance * 1e9 + 0.5), match_id) = 1""",
)
def semantic_reuse(spark, sf_dir):
    """Which earlier query's answer each query may reuse."""
    found = dense.nearest_earlier(corpus(spark, sf_dir).drop("category"), _REUSE)
    return found.select("id", "match_id", F.round("distance", 6).alias("distance"))


_SIGN = (
    "CASE WHEN substr(md5(p::VARCHAR || ':' || (d - 1)::VARCHAR), 1, 1) IN "
    "('0', '1', '2', '3', '4', '5', '6', '7') THEN 1.0 ELSE -1.0 END"
)
_CELLS = f"""
planes AS (SELECT p, list({_SIGN} ORDER BY d) AS signs
  FROM generate_series(0, {PLANES - 1}) AS g(p), generate_series(1, {DIMENSIONS}) AS h(d) GROUP BY p),
cells AS (SELECT id, sum(CASE WHEN list_inner_product(vec, signs) >= 0 THEN 1 << p ELSE 0 END) AS cell
  FROM v, planes GROUP BY id),
own AS (SELECT label, sum(CASE WHEN list_inner_product(mean, signs) >= 0 THEN 1 << p ELSE 0 END) AS cell
  FROM centre, planes GROUP BY label),
near AS (SELECT s.* FROM scored s JOIN cells c USING (id) JOIN own o ON o.label::VARCHAR = s.query_id
  WHERE bit_count(xor(o.cell::INTEGER, c.cell::INTEGER)) <= 1)"""


def _approximate(spark, sf_dir) -> DataFrame:
    """The cells are stored by their number, so that a search reads only the probed ones."""
    cells = stored_table(
        spark, f"cells-{PLANES}", f"{sf_dir}/embeddings.parquet",
        lambda: dense.build_cells(corpus(spark, sf_dir), PLANES, DIMENSIONS), by="cell",
    ).withColumn("cell", F.col("cell").cast("long"))
    return dense.approximate_top_k(label_queries(spark, sf_dir), cells, 5, PLANES, DIMENSIONS)


@query(
    "ann_topk",
    f"""WITH {_BASE}, {_SCORED}, {_CELLS}, {_ranked('5', source='near')}
      SELECT query_id, id, round(score, 6) AS score, rank FROM hits""",
)
def ann_topk(spark, sf_dir):
    return _shown(_approximate(spark, sf_dir))


@query(
    "ann_recall",
    f"""WITH {_BASE}, {_SCORED}, {_CELLS}, {_ranked('5', name='exact')}, {_ranked('5', source='near', name='approx')}
      SELECT e.query_id, count(*) AS exact_hits, count(a.id) AS found_hits, round(max(e.score), 6) AS best_exact,
        round(max(a.score), 6) AS best_found, round(count(a.id) / count(*), 6) AS recall
      FROM exact e LEFT JOIN approx a ON a.query_id = e.query_id AND a.id = e.id GROUP BY e.query_id""",
)
def ann_recall(spark, sf_dir):
    exact = dense.cosine_top_k(label_queries(spark, sf_dir), corpus(spark, sf_dir), 5)
    compared = dense.recall_table(exact, _approximate(spark, sf_dir))
    return compared.select(
        "query_id", "exact_hits", "found_hits",
        *[F.round(c, 6).alias(c) for c in ("best_exact", "best_found", "recall")],
    )


_RELEVANT = f"WITH {_BASE}, {_SCORED}, {_ranked('10')}, marked AS (SELECT *, query_id = label::VARCHAR AS relevant FROM hits)"


def _marked(spark, sf_dir) -> DataFrame:
    """Ten hits per query, relevant when they carry the label of the query."""
    vectors = corpus(spark, sf_dir)
    found = dense.cosine_top_k(label_queries(spark, sf_dir), vectors, 10)
    return found.join(vectors.select("id", "category"), "id").withColumn(
        "relevant", F.col("category").cast("string") == F.col("query_id")
    )


@query(
    "context_precision_at_k",
    f"""{_RELEVANT}, running AS (SELECT *, count(*) FILTER (relevant) OVER (PARTITION BY query_id ORDER BY rank) AS seen
        FROM marked)
      SELECT query_id, round(avg(relevant::INTEGER), 6) AS precision,
        round(coalesce(sum(CASE WHEN relevant THEN seen / rank END) / nullif(count(*) FILTER (relevant), 0), 0), 6)
          AS average_precision FROM running GROUP BY query_id""",
)
def context_precision_at_k(spark, sf_dir):
    found = evaluation.precision_at_k(_marked(spark, sf_dir))
    return found.select(
        "query_id", F.round("precision", 6).alias("precision"),
        F.round("average_precision", 6).alias("average_precision"),
    )


@query(
    "context_recall_at_k",
    f"""{_RELEVANT}, wanted AS (SELECT label::VARCHAR AS query_id, count(*) AS n FROM v GROUP BY label)
      SELECT m.query_id, w.n AS relevant_total, round(count(*) FILTER (relevant) / w.n, 6) AS recall
      FROM marked m JOIN wanted w USING (query_id) GROUP BY m.query_id, w.n""",
)
def context_recall_at_k(spark, sf_dir):
    wanted = corpus(spark, sf_dir).groupBy(F.col("category").cast("string").alias("query_id")).agg(
        F.count("*").alias("relevant_total")
    )
    found = evaluation.recall_at_k(_marked(spark, sf_dir), wanted)
    return found.select("query_id", "relevant_total", F.round("recall", 6).alias("recall"))


@query("pca_2d")
def pca_2d(spark, sf_dir):
    """Two components of every vector; the covariance is summed by tasks, 64 x 64 reaches the driver."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    rows = corpus(spark, sf_dir).withColumn("features", array_to_vector(vx.as_double(F.col("vector"))))
    model = PCA(k=2, inputCol="features", outputCol="pc").fit(rows)
    first, second = [float(x) for x in model.explainedVariance]
    parts = vector_to_array("pc")
    return model.transform(rows).select(
        "id", "category",
        parts[0].alias("pc1"), parts[1].alias("pc2"),
        F.lit(first).alias("explained_1"), F.lit(second).alias("explained_2"),
    )
