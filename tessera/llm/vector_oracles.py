"""DuckDB SQL for the two vector operators, by comparing every vector with every centroid."""

from __future__ import annotations


def _centroid_sql(rounds: int = 3) -> str:
    """Long form throughout: one row per component."""
    out = ["""WITH k AS MATERIALIZED (
  SELECT vec_id, embedding FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
v AS MATERIALIZED (
  SELECT vec_id, unnest(range(64)) AS i, CAST(floor(64 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x FROM k),
s AS MATERIALIZED (
  SELECT vec_id, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS c FROM k
  QUALIFY row_number() OVER (ORDER BY sha256('1:' || vec_id)) <= 16),
c0 AS MATERIALIZED (SELECT c, i, x FROM s JOIN v USING (vec_id))"""]
    for r in range(rounds + 1):
        out.append(f"""d{r} AS MATERIALIZED (
  SELECT vec_id, c.c, sum((v.x - c.x) * (v.x - c.x)) AS d FROM v JOIN c{r} c ON v.i = c.i GROUP BY vec_id, c.c),
a{r} AS MATERIALIZED (
  SELECT vec_id, c, d FROM d{r} QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c) = 1)""")
        if r < rounds:
            out.append(f"""m{r} AS MATERIALIZED (
  SELECT c, i, CAST(floor(CAST(sum(x) AS DOUBLE) / count(*)) AS BIGINT) AS x FROM a{r} JOIN v USING (vec_id) GROUP BY c, i),
c{r + 1} AS MATERIALIZED (
  SELECT o.c, o.i, coalesce(m.x, o.x) AS x FROM c{r} o LEFT JOIN m{r} m ON o.c = m.c AND o.i = m.i)""")
    return ",\n".join(out) + f""",
h AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY c)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
       CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       centroid_sha256
FROM a{rounds} JOIN h USING (c)"""


def _code_sql(rounds: int = 2) -> str:
    out = ["""WITH k AS MATERIALIZED (
  SELECT vec_id, label, embedding, len(embedding) // 16 AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
v AS MATERIALIZED (
  SELECT vec_id, j // w AS p, j % w AS i, x FROM (
    SELECT vec_id, w, unnest(range(len(embedding))) AS j,
           CAST(floor(256 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x FROM k)),
s AS MATERIALIZED (
  SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM k
  QUALIFY row_number() OVER (ORDER BY vec_id) <= 64),
c0 AS MATERIALIZED (SELECT p, e, i, x FROM s JOIN v USING (vec_id))"""]
    for r in range(rounds + 1):
        out.append(f"""d{r} AS MATERIALIZED (
  SELECT vec_id, v.p, c.e, sum((v.x - c.x) * (v.x - c.x)) AS d
  FROM v JOIN c{r} c ON v.p = c.p AND v.i = c.i GROUP BY vec_id, v.p, c.e),
a{r} AS MATERIALIZED (
  SELECT vec_id, p, e, d FROM d{r} QUALIFY row_number() OVER (PARTITION BY vec_id, p ORDER BY d, e) = 1)""")
        if r < rounds:
            out.append(f"""m{r} AS MATERIALIZED (
  SELECT p, e, i, CAST(floor(CAST(sum(x) AS DOUBLE) / count(*)) AS BIGINT) AS x
  FROM a{r} JOIN v USING (vec_id, p) GROUP BY p, e, i),
c{r + 1} AS MATERIALIZED (
  SELECT o.p, o.e, o.i, coalesce(m.x, o.x) AS x
  FROM c{r} o LEFT JOIN m{r} m ON o.p = m.p AND o.e = m.e AND o.i = m.i)""")
    return ",\n".join(out) + f""",
h AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, i)) AS codebooks_sha256 FROM c{rounds}),
t AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
      FROM a{rounds} GROUP BY vec_id)
SELECT t.vec_id, code, error, CAST(sum(error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error, codebooks_sha256
FROM t JOIN k USING (vec_id), h"""


CENTROIDS = _centroid_sql()
CODES = _code_sql()
