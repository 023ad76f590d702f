"""Replies derived from every conversation turn: JSON among noise, and chosen options; with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from visitgraph.functions.replies import MARKS, OPTIONS, chosen_option, recovered

QUERIES, SQL = {}, {}
#: A reply for each turn, by a rule of its ids: the object alone, after a remark, in a list, cut off, after an object
#: without the keys, fenced, after a stray quote, a plain number, nested in another, with brackets in its strings.
REPLIES = """
WITH o AS (SELECT conv_id, turn, (conv_id * 7 + turn) % 10 AS form, concat('{{"order_no": "6', lpad(CAST(conv_id % 10000000 AS VARCHAR(20)), 7, '0'), '", "serial": "USN', CAST(turn AS VARCHAR(20)), '", "pages": [', CAST(length(text) AS VARCHAR(20)), ', {{"note": "a}} \\\\"b\\\\" ] {{"}}]}}') AS obj,
  regexp_replace(substr(text, 1, 30), '[^A-Za-z ]', '') AS said FROM {conversations}),
replies AS (SELECT conv_id, turn, form, CASE form WHEN 0 THEN obj WHEN 1 THEN concat(said, ' {{not json}} ', obj, ' }} done') WHEN 2 THEN concat('[', obj, ']') WHEN 3 THEN substr(obj, 1, length(obj) - 1)
  WHEN 4 THEN concat('{{"order_no": "1"}} ', obj, ' ', obj) WHEN 5 THEN concat('```json ', obj, ' ```') WHEN 6 THEN concat(said, ' "quoted: ', obj) WHEN 7 THEN CAST(turn AS VARCHAR(20)) WHEN 8 THEN concat('{{"answer": ', obj, '}}') ELSE concat('  ', said, '  ') END AS reply FROM o)
"""
_DUCK = REPLIES.format(conversations="conversations").replace("\\\\", "\\")
_KEYS = ("order_no", "serial", "pages")


def replies(spark, sf_dir):
    return spark.sql(REPLIES + "SELECT * FROM replies", conversations=spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def reply_recovery(spark, sf_dir):
    """The object of every reply, its order number and how many characters it has."""
    d = replies(spark, sf_dir).withColumn("r", recovered(F.col("reply"), _KEYS))
    return d.select("conv_id", "turn", F.col("r.outcome").alias("outcome"), F.get_json_object("r.json", "$.order_no").alias("order_no"), F.length("r.json").cast("long").alias("chars"))


def job_nature_reply(spark, sf_dir):
    """One option out of every turn's first reply, else out of its second."""
    d = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    first, second = F.expr(NATURE.format(n="conv_id + turn")), F.expr(NATURE.format(n="conv_id * 3 + turn + 5"))
    return d.select("conv_id", "turn", chosen_option(first).alias("first"), chosen_option(first, second).alias("nature"))


#: Replies about a marked option, by a number; some are in no known sentence.
NATURE = "CASE ({n}) % 11 WHEN 0 THEN 'pm' WHEN 1 THEN '\"CM\".' WHEN 2 THEN 'PM (circled)' WHEN 3 THEN 'The circled word is  CM!' WHEN 4 THEN 'marked option INS' WHEN 5 THEN 'The word FCO is selected.' WHEN 6 THEN 'CM is the marked choice' WHEN 7 THEN 'CM or PM' WHEN 8 THEN 'PM is not circled' WHEN 9 THEN 'CM, PM, FCO, INS' ELSE ' ' END"
_OPTION, _MARK = "|".join(OPTIONS), "|".join(MARKS)
_PLAIN = "regexp_replace(trim(regexp_replace(upper(trim(regexp_replace({r}, '\\s+', ' ', 'g'))), '[\"''`]', '', 'g')), '[.!]$', '')"
_CHOSEN = rf"coalesce(nullif(regexp_extract({_PLAIN}, '^({_OPTION})(?: \((?:{_MARK})\)| IS (?:THE )?(?:{_MARK}) (?:OPTION|WORD|CHOICE))?$', 1), ''), nullif(regexp_extract({_PLAIN}, '^(?:(?:THE )?(?:{_MARK}) (?:OPTION|WORD|CHOICE) (?:IS )?({_OPTION})|(?:THE )?WORD (?:{_OPTION}) IS (?:{_MARK}))$', 1), ''), nullif(regexp_extract({_PLAIN}, '^(?:THE )?WORD ({_OPTION}) IS (?:{_MARK})$', 1), ''))"

#: The scan by a fold over characters, from each brace that all keys follow.
SQL["reply_recovery"] = _DUCK.rstrip() + r""",
t AS (SELECT conv_id, turn, trim(reply) AS t, CASE WHEN json_valid(trim(reply)) THEN trim(reply) END AS j FROM replies),
b AS (SELECT conv_id, turn, t, unnest(list_filter(range(1, length(t) + 1), lambda i: substr(t, i, 1) = '{')) AS i FROM t),
c AS (SELECT conv_id, turn, i, substr(t, i) AS r FROM b WHERE contains(substr(t, i), '"order_no"') AND contains(substr(t, i), '"serial"') AND contains(substr(t, i), '"pages"')),
f AS (SELECT *, list_reduce(list_transform(string_split(r, ''), lambda x, n: {'x': x, 'n': n, 'deep': 0, 'q': 0, 'esc': 0, 'fin': 0}),
  lambda a, x: CASE WHEN a.fin > 0 THEN a WHEN a.esc = 1 THEN {'x': '', 'n': x.n, 'deep': a.deep, 'q': a.q, 'esc': 0, 'fin': 0} WHEN x.x = '\' THEN {'x': '', 'n': x.n, 'deep': a.deep, 'q': a.q, 'esc': 1, 'fin': 0}
   WHEN x.x = '"' THEN {'x': '', 'n': x.n, 'deep': a.deep, 'q': 1 - a.q, 'esc': 0, 'fin': 0} WHEN a.q = 1 THEN {'x': '', 'n': x.n, 'deep': a.deep, 'q': 1, 'esc': 0, 'fin': 0}
   WHEN x.x IN ('{', '[') THEN {'x': '', 'n': x.n, 'deep': a.deep + 1, 'q': 0, 'esc': 0, 'fin': 0}
   WHEN x.x IN ('}', ']') THEN {'x': '', 'n': x.n, 'deep': a.deep - 1, 'q': 0, 'esc': 0, 'fin': CASE WHEN a.deep = 1 THEN x.n::INT ELSE 0 END} ELSE {'x': '', 'n': x.n, 'deep': a.deep, 'q': 0, 'esc': 0, 'fin': 0} END, {'x': '', 'n': 0::BIGINT, 'deep': 0, 'q': 0, 'esc': 0, 'fin': 0}).fin AS fin FROM c),
p AS (SELECT conv_id, turn, i, substr(r, 1, fin) AS p FROM f WHERE fin > 0),
ok AS (SELECT conv_id, turn, arg_min(p, i) AS p FROM p WHERE list_has_all(json_keys(CASE WHEN json_valid(p) THEN p END), ['order_no', 'serial', 'pages']) GROUP BY ALL),
w AS (SELECT t.*, p, j IS NOT NULL AS valid, coalesce(json_type(j) = 'OBJECT' AND list_has_all(json_keys(j), ['order_no', 'serial', 'pages']), false) AS usable FROM t LEFT JOIN ok USING (conv_id, turn))
SELECT conv_id, turn, CASE WHEN usable THEN 'whole' WHEN valid THEN 'wrong_shape' WHEN p IS NOT NULL THEN 'embedded' ELSE 'none' END AS outcome,
 CASE WHEN usable OR NOT valid THEN json_extract_string(p, '$.order_no') END AS order_no, CASE WHEN usable OR NOT valid THEN length(p) END AS chars FROM w"""
SQL["job_nature_reply"] = f"""WITH r AS (SELECT conv_id, turn, {NATURE.format(n="conv_id + turn")} AS a, {NATURE.format(n="conv_id * 3 + turn + 5")} AS b FROM conversations)
SELECT conv_id, turn, coalesce({_CHOSEN.format(r="a")}, 'UNKNOWN') AS first, coalesce({_CHOSEN.format(r="a")}, {_CHOSEN.format(r="b")}, 'UNKNOWN') AS nature FROM r"""
QUERIES |= {"reply_recovery": reply_recovery, "job_nature_reply": job_nature_reply}
