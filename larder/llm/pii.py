"""Personal data: exact base detectors and bootstrapped contextual extraction.

Base detectors find e-mail addresses, IP addresses, card and phone numbers by
pattern and validity. They seed a bootstrap: every base span and every other
word with digits is a mention in a lexical context (the words around it).
Contexts that hold known entities become trusted patterns, instances seen in
trusted patterns become known, and so on for a few rounds over the
pattern-instance graph. Unseen instances don't count against a context as
clearly non-personal words do (dates, times, amounts, few digits), but it needs
a share of known ones that rises with the rounds. Mentions of accepted instances in
trusted patterns are added as spans of kind ``id``. Everything is DataFrame expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import materialise, pick, positional, spread_join

KINDS = ("email", "ip", "card", "phone")
EXTRA = "id"

# The patterns of the contract. Possessive repeats and the conditions before
# the first character (not inside a run, or right after the last match) change
# no match: they stop a long run from being tried again from each of its characters.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must contain for a pattern to match at all.
HINTS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
_WORD = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"


@dataclass(frozen=True)
class BootstrapParams:
    """``min_digits``: least digits of an identifier that no base pattern finds;
    ``context``: characters looked at on either side; ``min_known``: least
    known instances of a pattern; ``first_share`` / ``last_share``: least share
    of known ones in the first and the last round; ``pattern_confidence`` (known
    ones against clearly non-personal ones) / ``instance_score``: thresholds;
    ``rounds``: at most."""
    min_digits: int = 4
    first_share: float = 0.3
    last_share: float = 0.7
    context: int = 64
    min_known: int = 5
    pattern_confidence: float = 0.9
    instance_score: float = 0.9
    rounds: int = 3


def _hits(text: Column, pattern: str, hint: str) -> tuple:
    """Matches of a pattern and the gaps around them, as arrays; no match: empty."""
    maybe = text.contains(hint) if hint else text.rlike("[0-9]")
    none = F.array().cast("array<string>")
    return (F.when(maybe, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none),
            F.when(maybe, F.split(text, pattern, -1)).otherwise(none))


def _placed(hits: str, gaps: str) -> str:
    """SQL for the hits with start and end in code points, from the gaps' lengths.
    No array is named only inside a lambda, where Spark would make it anew for each element."""
    return f"""aggregate(
        filter(zip_with({hits}, {gaps}, (m, g) -> named_struct('g', length(g), 'm', m)), x -> x.m IS NOT NULL),
        named_struct('p', 0, 'r', cast(array() AS array<struct<s: int, e: int, m: string>>)),
        (a, x) -> named_struct('p', a.p + x.g + length(x.m), 'r', concat(a.r, array(named_struct(
            's', a.p + x.g, 'e', a.p + x.g + length(x.m), 'm', x.m)))),
        a -> a.r)"""


_DIGITS = "regexp_replace(x.m, '[^0-9]', '')"
VALID = {
    "email": "true",
    "ip": "forall(split(x.m, '[.]'), v -> length(ltrim('0', v)) <= 3 AND int(concat('0', substr(ltrim('0', v), 1, 3))) <= 255)",
    "card": f"""CASE WHEN length({_DIGITS}) BETWEEN 13 AND 19 THEN aggregate(
        transform(filter(split(reverse({_DIGITS}), ''), c -> c <> ''), (c, i) -> int(c) * (1 + i % 2) - CASE WHEN i % 2 = 1 AND int(c) > 4 THEN 9 ELSE 0 END),
        0, (t, v) -> t + v) % 10 = 0 ELSE false END""",
    "phone": f"length({_DIGITS}) BETWEEN 9 AND 15",
}


def base_spans(df: DataFrame, text: str) -> DataFrame:
    """``df`` with an array ``b_<kind>`` of (s, e, m) per kind for the column
    ``text`` (null: no spans)."""
    t = F.coalesce(F.col(text), F.lit(""))
    for kind in KINDS:
        h, g = _hits(t, PATTERNS[kind], HINTS[kind])
        df = df.withColumns({f"h_{kind}": h, f"g_{kind}": g})
    df = df.withColumns({f"p_{k}": F.expr(_placed(f"h_{k}", f"g_{k}")) for k in KINDS})
    df = df.withColumns({f"b_{k}": F.expr(f"filter(p_{k}, x -> {VALID[k]})") for k in KINDS})
    return df.drop(*[f"{x}_{k}" for k in KINDS for x in "hgp"])


# Words with digits that are clearly no identifiers: years, dates, times, amounts.
_PLAIN = (r"^(?:(?:1[5-9]|20)[0-9]{2}s?|[0-9]{4}[-/.][0-9]{1,2}[-/.][0-9]{1,2}|[0-9]{1,2}[-/.][0-9]{1,2}[-/.][0-9]{2,4}"
          r"|[0-9]{1,2}:[0-9]{2}(?::[0-9]{2})?|[0-9]{1,3}(?:[,.][0-9]{3})+(?:[,.][0-9]{1,2})?|[0-9]+[,.][0-9]{1,2})$")
_BLOCK = 1024


def _mentions(df: DataFrame, text: str, p: BootstrapParams) -> DataFrame:
    """``df`` with ``mentions``: base spans, and words with digits that none of
    them touches, with their place, instance, the words around them, whether
    they are base spans (``seed``) and whether they are clearly non-personal (``bad``)."""
    t = F.coalesce(F.col(text), F.lit(""))
    h, g = _hits(t, _WORD, "")
    spans = "concat(" + ", ".join(f"b_{k}" for k in KINDS) + ")"
    df = df.withColumns({"h_w": h, "g_w": g, "s_b": F.expr(spans)}).withColumn("p_w", F.expr(_placed("h_w", "g_w")))
    core = "regexp_replace(lower(x.m), '^[^a-z0-9+]+|[^a-z0-9]+$', '')"
    words = f"""transform(filter(p_w, x -> NOT exists(s_b, y -> y.s < x.e AND y.e > x.s)),
        x -> named_struct('s', x.s, 'e', x.e, 'inst', {core}, 'seed', false))"""
    df = df.withColumn("m_w", F.expr(f"concat(transform(s_b, x -> named_struct('s', x.s, 'e', x.e, 'inst', lower(x.m), 'seed', true)), {words})"))
    # Blocks of equal length in code points: a place is found without reading the text up to it.
    df = df.withColumn("k_w", F.when(F.size("m_w") > 0, F.regexp_extract_all(t, F.lit(f"(?s).{{1,{_BLOCK}}}"), F.lit(0)))
                       .otherwise(F.array().cast("array<string>")))
    n, block = p.context, lambda at: f"coalesce(get(k_w, cast({at} AS int)), '')"
    before = f"lower(right(concat({block(f'x.s div {_BLOCK} - 1')}, left({block(f'x.s div {_BLOCK}')}, x.s % {_BLOCK})), {n}))"
    after = f"lower(left(concat(substr({block(f'x.e div {_BLOCK}')}, x.e % {_BLOCK} + 1), {block(f'x.e div {_BLOCK} + 1')}), {n}))"
    word, space = r"[^\\x20\\x09-\\x0D]", r"[\\x20\\x09-\\x0D]"
    tidy = lambda e: f"regexp_replace({e}, '[0-9]+', '#')"
    last = lambda k: tidy(f"regexp_extract(x.b, '({word}+)(?:{space}+{word}+){{{k}}}{space}+{word}*$', 1)")
    first = tidy(f"regexp_extract(x.a, '^{word}*{space}+({word}+)', 1)")
    made = f"""transform(transform(m_w, x -> named_struct('s', x.s, 'e', x.e, 'inst', x.inst, 'seed', x.seed, 'b', {before}, 'a', {after})),
        x -> named_struct('s', x.s, 'e', x.e, 'inst', x.inst, 'l1', {last(0)}, 'l2', {last(1)}, 'r1', {first}, 'seed', x.seed,
        'bad', NOT x.seed AND (length(regexp_replace(x.inst, '[^0-9]', '')) < {p.min_digits} OR x.inst RLIKE '{_PLAIN}')))"""
    return df.withColumn("mentions", F.expr(made.replace("{_PLAIN}", _PLAIN))).drop("h_w", "g_w", "p_w", "s_b", "m_w", "k_w")


def _trusted(mentions: DataFrame, p: BootstrapParams) -> DataFrame:
    """``pattern, inst`` of accepted instances in trusted patterns, from
    ``mentions (pattern, inst, seed, bad)``."""
    edges = materialise(mentions.groupBy("pattern", "inst").agg(F.max("seed").alias("seed"), F.min("bad").alias("bad")), "pii-graph")
    known = edges.groupBy("inst").agg(F.max(F.col("seed").cast("double")).alias("score"))
    for turn in range(p.rounds):
        known = materialise(known, "pii-instances")
        held = spread_join(edges, known, "inst").groupBy("pattern").agg(
            F.sum("score").alias("known"), F.count(F.lit(1)).alias("all"), F.sum(F.col("bad").cast("double")).alias("bad"))
        share = p.first_share + (p.last_share - p.first_share) * turn / max(1, p.rounds - 1)
        patterns = held.filter((F.col("known") >= p.min_known) & (F.col("known") >= share * F.col("all"))).select(
            "pattern", (F.col("known") / (F.col("known") + F.col("bad") + 0.25)).alias("conf")).filter(F.col("conf") >= p.pattern_confidence)
        patterns = materialise(patterns, "pii-patterns")
        seen = spread_join(edges.filter(~F.col("bad")), patterns, "pattern")
        found = seen.groupBy("inst").agg(F.max("seed").alias("seed"), (1 - F.exp(F.sum(F.log(F.greatest(
            1 - F.col("conf"), F.lit(1e-9)))))).alias("score")).select(
            "inst", F.when(F.col("seed"), F.lit(1.0)).otherwise(F.col("score")).alias("score"))
        known = known.withColumnRenamed("score", "old").join(found, "inst", "left").select(
            "inst", F.greatest("old", F.when(F.col("score") >= p.instance_score, F.col("score")).otherwise(0.0)).alias("score"))
    accepted = materialise(known, "pii-instances").filter(F.col("score") >= p.instance_score)
    fresh = spread_join(edges.filter(~F.col("seed") & ~F.col("bad")), patterns, "pattern").select("pattern", "inst")
    return spread_join(fresh, accepted.select("inst"), "inst")


def _patterns_of(mentions: DataFrame) -> DataFrame:
    """A row per mention and lexical pattern: the two words before, or the
    words on either side."""
    return mentions.withColumn("pattern", F.explode(F.array(
        F.when((F.col("l2") != "") & (F.col("l1") != ""), F.concat_ws(" ", F.lit("2"), "l2", "l1")),
        F.when((F.col("l1") != "") & (F.col("r1") != ""), F.concat_ws(" ", F.lit("1"), "l1", F.lit("_"), "r1"))))).filter(
        F.col("pattern").isNotNull())


def _extras(found: DataFrame, p: BootstrapParams) -> DataFrame:
    """``text_key, extra`` (array of (s, e)) from ``found (text_key, mentions)``."""
    each = _patterns_of(found.select("text_key", F.explode("mentions").alias("x")).select("text_key", "x.*"))
    trusted = _trusted(each.select("pattern", "inst", "seed", "bad"), p)
    new = each.filter(~F.col("seed")).join(trusted, ["pattern", "inst"]).select("text_key", "s", "e").distinct()
    return materialise(new.groupBy("text_key").agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("extra")), "pii-extra")


def _listed(kind: str, column: str) -> Column:
    return F.transform(F.col(column), lambda x: F.concat_ws(":", F.lit(kind), x["s"].cast("string"), x["e"].cast("string")))


def _tagged(kind: str, column: str) -> Column:
    """Spans as (start, negated end, placeholder): of equal starts the longest comes first."""
    return F.transform(F.col(column), lambda x: F.struct(
        x["s"].alias("s"), (-x["e"]).alias("e"), F.lit(f"<{kind.upper()}>").alias("tag")))


def find_pii(docs: DataFrame, params: BootstrapParams = BootstrapParams(), id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_email, n_ip, n_card, n_phone,
    base_sha256, spans``.

    Null and empty texts have no spans (the digest is that of the empty
    string, ``spans`` is empty). Rows with equal texts get equal spans; null
    ids stay. The texts are read once; what moves later are mentions with their
    contexts, keyed by the text's MD5."""
    d = pick(docs, doc_id=id_col, text=text_col)
    d = _mentions(base_spans(d, "text"), "text", params)
    base = F.concat(*[_listed(k, f"b_{k}") for k in KINDS])
    found = materialise(d.select(
        "doc_id", F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("text_key"),
        *[F.size(f"b_{k}").cast("long").alias(f"n_{k}") for k in KINDS], F.array_join(base, ",").alias("base"), "mentions"), "pii")
    out = spread_join(found.drop("mentions"), _extras(found.select("text_key", "mentions"), params), "text_key", "left")
    extra = F.coalesce("extra", F.array().cast("array<struct<s: int, e: int>>"))
    return out.withColumn("extra", extra).select(
        "doc_id", *[f"n_{k}" for k in KINDS], F.sha2("base", 256).alias("base_sha256"),
        F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), F.when(
            F.size("extra") > 0, F.array_join(_listed(EXTRA, "extra"), ","))).alias("spans"))


def redact(docs: DataFrame, params: BootstrapParams = BootstrapParams(), text_col: str = "text",
           length_col: str = "n_chars") -> DataFrame:
    """``docs`` with every span replaced by ``<KIND>`` in the text column and,
    where there is one, the column of lengths brought up to date. Overlapping
    spans become one. Texts without spans, null ones too, stay as they are, and
    so do null ids, repeated rows and extra columns. The detectors run once:
    rows are written with their spans and mentions, and cut from those."""
    flat, at, restore = positional(docs)
    text = at(text_col)
    key = F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))
    marked = materialise(_mentions(base_spans(flat.withColumn("text_key", key), text), text, params), "pii")
    extras = _extras(marked.filter(F.size("mentions") > 0).select("text_key", "mentions"), params)
    marked = spread_join(marked.drop("mentions"), extras, "text_key", "left")
    spans = F.sort_array(F.concat(*[_tagged(k, f"b_{k}") for k in KINDS], _tagged(EXTRA, "more")))
    marked = marked.withColumn("more", F.coalesce("extra", F.array().cast("array<struct<s: int, e: int>>"))).withColumn("spans", spans)
    cut = f"""aggregate(spans, named_struct('p', 0, 'r', cast(array() AS array<string>)),
        (a, x) -> CASE WHEN x.s < a.p THEN named_struct('p', greatest(a.p, -x.e), 'r', a.r)
            ELSE named_struct('p', -x.e, 'r', concat(a.r, array(substr({text}, a.p + 1, x.s - a.p), x.tag))) END,
        a -> concat(array_join(a.r, ''), substr({text}, a.p + 1)))"""
    marked = marked.withColumn(text, F.when(F.size("spans") > 0, F.expr(cut)).otherwise(F.col(text)))
    if length_col in docs.columns:
        length = at(length_col)
        marked = marked.withColumn(length, F.when(F.size("spans") > 0, F.length(text).cast(docs.schema[length_col].dataType))
                                   .otherwise(F.col(length)))
    return restore(marked)
