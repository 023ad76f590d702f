"""Structured answers out of noisy replies: the first JSON object with all keys, and one chosen option."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from visitgraph.functions.text import bind, text_of

#: What ends a plain stretch of JSON: an escaped sign, a quote, a bracket.
TOKENS = r'(?s)\\.|["{}\[\]]|[^\\"{}\[\]]+|\\'
SCALAR = r'^(?:-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?|true|false|null|"(?:[^"\\\x00-\x1f]|\\.)*")$'
# The options of a form's field, and the sentences that choose one.
OPTIONS = ("CM", "PM", "FCO", "INS")
MARKS = ("CIRCLED", "MARKED", "SELECTED")
NOUNS = ("OPTION", "WORD", "CHOICE")
SENTENCES = ("{option}", "{option} ({mark})", "{the}{mark} {noun} {is}{option}", "{the}WORD {option} IS {mark}", "{option} IS {the}{mark} {noun}")


def balanced_end(text: Column) -> Column:
    """How many characters the value has with whose bracket ``text`` begins; 0 if that bracket is never closed.

    One pass over the tokens: brackets count outside strings only, and an escaped sign is one token. Escapes outside
    strings can't be JSON, whoever parses the value refuses it.
    """
    n = lambda v, kind="int": F.lit(v).cast(kind)
    start = F.struct(n(0).alias("at"), n(0).alias("deep"), F.lit(False).alias("quoted"), n(0).alias("end"))

    def step(acc: Column, t: Column) -> Column:
        at = acc["at"] + F.length(t)
        opens, closes = ~acc["quoted"] & t.isin("{", "["), ~acc["quoted"] & t.isin("}", "]")
        deep = acc["deep"] + F.when(opens, 1).when(closes, -1).otherwise(0)
        end = F.when(closes & (deep == 0), at).otherwise(0)
        moved = F.struct(at.alias("at"), deep.cast("int").alias("deep"), (acc["quoted"] != (t == '"')).alias("quoted"), end.cast("int").alias("end"))
        return F.when(acc["end"] > 0, acc).otherwise(moved)

    return F.aggregate(F.regexp_extract_all(text, F.lit(TOKENS), F.lit(0)), start, step, lambda acc: acc["end"])


def is_object(part: Column, required: tuple[str, ...]) -> Column:
    """Whether a balanced ``part`` parses, and is an object with all ``required`` keys."""
    keys = F.json_object_keys(part)
    return F.coalesce(F.try_parse_json(part).isNotNull() & F.forall(F.array(*map(F.lit, required)), lambda k: F.array_contains(keys, k)), F.lit(False))


def recovered(reply: Column, required: tuple[str, ...]) -> Column:
    """struct(outcome, json): the object that a reply holds.

    ``whole``: the reply is that object. ``wrong_shape``: it is JSON, but not such an object, and nothing in it is taken
    for one. ``embedded``: the first object in it with all keys, among other text. ``none``: there is none. White space
    and a byte order mark around the reply don't count; null is an empty reply; an
    object that has a key twice is ambiguous and counts as none. Native: every opening brace after which
    all required keys still come is tried by one pass over the rest, so a reply with many such braces takes their number
    times its length.
    """

    def read(t: Column) -> Column:
        nested = t.rlike(r"^[{\[]") & (balanced_end(t) == F.length(t)) & F.try_parse_json(t).isNotNull()
        whole = F.coalesce(nested, F.lit(False)) | t.rlike(SCALAR)
        positions = F.filter(F.sequence(F.lit(1), F.greatest(F.length(t), F.lit(1))), lambda i: F.substring(t, i, F.lit(1)) == "{")
        rests = F.transform(positions, lambda i: F.substring(t, i, F.length(t)))
        rests = F.filter(rests, lambda r: F.forall(F.array(*[F.lit(f'"{k}"') for k in required]), lambda k: F.contains(r, k)))
        parts = F.transform(rests, lambda r: F.substring(r, F.lit(1), balanced_end(r)))
        found = F.try_element_at(F.filter(parts, lambda p: (p != "") & is_object(p, required)), F.lit(1))
        outcome = F.when(whole & is_object(t, required), F.struct(F.lit("whole").alias("outcome"), t.alias("json")))
        outcome = outcome.when(whole, F.struct(F.lit("wrong_shape").alias("outcome"), F.lit(None).cast("string").alias("json")))
        return outcome.otherwise(bind(found, lambda f: F.struct(F.when(f.isNotNull(), "embedded").otherwise("none").alias("outcome"), f.alias("json"))))

    return bind(F.regexp_replace(F.regexp_replace(text_of(reply), r"^[\s\x{FEFF}]+", ""), r"\s+$", ""), read)


def chosen_option(reply: Column, fallback: Column | None = None) -> Column:
    """The one option that a reply affirms in a known sentence, else ``UNKNOWN``; then ``fallback`` is read, if given.

    Case, quotes, runs of white space and a final ``.`` or ``!`` don't count. Doubt, negation or several options are
    in no known sentence.
    """
    plain = F.regexp_replace(F.upper(F.trim(F.regexp_replace(text_of(reply), r"\s+", " "))), "[\"'`]", "")
    plain = F.regexp_replace(F.trim(plain), r"[.!]$", "")
    words = {"option": f"({'|'.join(OPTIONS)})", "mark": f"(?:{'|'.join(MARKS)})", "noun": f"(?:{'|'.join(NOUNS)})", "the": "(?:THE )?", "is": "(?:IS )?"}
    forms = ["^" + s.replace("(", r"\(").replace(")", r"\)").format(**words) + "$" for s in SENTENCES]
    hit = bind(plain, lambda p: F.coalesce(*[F.nullif(F.regexp_extract(p, f, 1), F.lit("")) for f in forms]))
    return F.coalesce(hit, F.lit("UNKNOWN") if fallback is None else chosen_option(fallback))
