"""Greedy clustering as recursive SQL: what queries of clusters are held against."""


def greedy(source: str, least: float, name: str = "g") -> str:
    """Tables ``{name}s`` (``source``) and ``{name}`` with ``block, id, seq, centroid``.

    ``source`` has ``block, rn, id, seq``; each step takes the next sequence of
    every block, which joins the first centroid that agrees in ``least`` of the
    places, or becomes one.
    """
    near = f"CASE WHEN length(c['s']) = length({name}s.seq) THEN 1 - hamming(c['s'], {name}s.seq) / CAST(length({name}s.seq) AS DOUBLE) >= {least} - 1e-9 ELSE false END"
    return f"""{name}s AS MATERIALIZED ({source}),
 {name} AS (SELECT block, rn, id, seq, id AS centroid, [{{'s': seq, 'i': id}}] AS cs FROM {name}s WHERE rn = 1
  UNION ALL SELECT block, rn, id, seq, coalesce(f, id), CASE WHEN f IS NULL THEN list_append(cs, {{'s': seq, 'i': id}}) ELSE cs END FROM (
   SELECT {name}s.*, {name}.cs, [c['i'] FOR c IN {name}.cs IF {near}][1] AS f FROM {name} JOIN {name}s ON {name}s.block = {name}.block AND {name}s.rn = {name}.rn + 1))"""


def distinct_rows(block: str, table: str = "rearrangements") -> str:
    """The distinct junctions of each block in order of abundance, as a source of :func:`greedy`."""
    return f"""SELECT block, seq, id, row_number() OVER (PARTITION BY block ORDER BY d DESC, id) AS rn FROM (
  SELECT block, seq, max(duplicate_count) AS d, arg_min(sequence_id, (-duplicate_count, sequence_id)) AS id FROM (SELECT {block} AS block, junction AS seq, duplicate_count, sequence_id FROM {table}) GROUP BY block, seq)"""
