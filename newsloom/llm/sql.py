"""Independent SQL for the queries that SQL can express over whole tables."""

_CLEAR = "(SELECT feed_articleid AS id, min(content) AS content FROM processed_article WHERE mode = 'cleartext' AND content IS NOT NULL GROUP BY 1)"

_SETS = f"""
words AS (SELECT id, regexp_extract_all(lower(content), '[\\p{{L}}\\p{{N}}]+') AS w FROM {_CLEAR}),
runs AS (SELECT DISTINCT id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s
         FROM (SELECT id, w, unnest(range(1, len(w) - 1)) AS i FROM words WHERE len(w) >= 30)),
sizes AS (SELECT id, count(*) AS n FROM runs GROUP BY 1),
shared AS (SELECT a.id AS x, b.id AS y, count(*) AS c FROM runs a JOIN runs b ON a.s = b.s AND a.id < b.id GROUP BY 1, 2),
pairs AS (SELECT x, y FROM shared JOIN sizes p ON p.id = x JOIN sizes q ON q.id = y WHERE 2 * c >= p.n + q.n - c)"""

_LINES = f"""
docs AS (SELECT DISTINCT p.id, content, siteid FROM {_CLEAR} p JOIN feed_article f ON f.id = p.id),
ls AS (SELECT DISTINCT id, siteid, regexp_replace(trim(regexp_replace(lower(unnest(string_split(content, chr(10)))), '[ \\t\\x{{00A0}}]+', ' ', 'g'), ' '), '[0-9]+', '#', 'g') AS line FROM docs),
n AS (SELECT siteid, count(*) AS docs FROM docs GROUP BY 1),
hot AS (SELECT ls.siteid, line FROM ls JOIN n ON n.siteid = ls.siteid WHERE line <> '' GROUP BY ls.siteid, line, docs HAVING count(*) >= 5 AND count(*) >= 0.1 * docs)"""

ORACLE = {
    "p2_found": f"WITH {_SETS} SELECT x AS first_id, y AS second_id FROM pairs",
    "p5_found": f"WITH {_LINES} SELECT DISTINCT hostname, line FROM hot JOIN site ON site.id = hot.siteid",
}
