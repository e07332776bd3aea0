"""Personal data: fixed patterns, and identifiers that bootstrapped contexts give away.

What the fixed patterns find seeds a graph of lexical contexts (one to three words before, behind, or on both sides, digits
by their shape) and values (words, and digit groups with blanks between them). A context is trusted by the share of known values in it,
provided that one of its words stands beside shaped values in a fair share of all its places in the corpus, so that everyday words give
nothing away. A value is trusted by the contexts that it occurs in; a few rounds let trust spread. Values of fitting shape that trusted
contexts surround, but that no fixed pattern accepts, are reported too. All of it is DataFrame expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hoardline.llm.common import free_names, row_hash, row_key, span_text, text_or_empty
from hoardline.session import cut_lineage

KINDS = ("email", "ip", "card", "phone")
NEAR = 64  # characters looked at on each side of a value
RUN = 128  # matches that are gathered in one go
START = "\x02"  # the word before a text's first

# The stated patterns. Possessive repeats and look-behinds change no match; they keep long runs linear and off the stack.
# A card with fewer than 12 digits is dropped anyway, and no part of its run can be longer.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){11,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Up to 19 short groups of digits with single blanks between them, else a word with a digit or an at sign.
GROUPS = r"[+(]{0,2}[0-9][0-9()-]{0,8}+(?:\x20[(]?[0-9][0-9()-]{0,8}+){1,18}(?![^\s.,;:!?\"'])"
TOKEN = rf"(?<!\S)(?:{GROUPS}|[^\s0-9@]*+[0-9@]\S*+)"
WORDS = 3  # words of a context on each side
PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


@dataclass(frozen=True)
class Settings:
    """A context is trusted from ``least_values`` known values and a share of ``least_share``, if ``least_rate`` of all places of
    one of its words are within three words of a shaped value of the kind; a value is reported from ``least_score``."""

    rounds: int = 3
    least_values: int = 3
    least_share: float = 0.6
    least_score: float = 0.8
    least_rate: float = 0.05


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check digit is right: from the right, every second digit counts double, less 9 if above 9."""
    reverse = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(reverse, i, F.lit(1)).cast("int")
        double = 2 * d - F.when(d > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, double).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _keep_card(value: Column) -> Column:
    n = F.length(_digits(value))
    return F.when(n.between(12, 19), _luhn(_digits(value))).otherwise(False)


RULES = {
    "email": (EMAIL, "@", None),
    "ip": (IP, ".", lambda v: v.rlike(rf"^{PART}(?:\.{PART}){{3}}$")),
    "card": (CARD, "", _keep_card),
    "phone": (PHONE, "+", lambda v: F.length(_digits(v)).between(9, 15)),
}
SPAN = "array<struct<start:long,no:int,end:long,kind:string>>"
FOUND = "array<struct<start:long,end:long,value:string,left:string,right:string>>"


def _collected(text: Column, pattern: str, kind: str, item, empty: str) -> Column:
    """Items of all matches in order: ``item(start, match, text before, text behind)`` gives an item or null; the texts reach back or on by
    ``NEAR`` characters, over other matches too, or to the text's ends. The texts between the
    matches and the matches themselves tell where each one starts."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    n = F.size(matches)
    none = F.array(F.lit(""))
    pairs = F.zip_with(matches, F.slice(gaps, F.lit(1), n), lambda m, g: F.struct(m.alias("m"), g.alias("g")))
    behind = F.zip_with(F.slice(gaps, F.lit(2), n), F.concat(F.slice(matches, F.lit(2), n), none), lambda h, m: F.struct(h.alias("h"), F.substring(m, 1, NEAR).alias("next")))
    zipped = F.zip_with(pairs, behind, lambda x, y: F.struct(x["m"].alias("m"), x["g"].alias("g"), y["h"].alias("h"), y["next"].alias("next")))

    ends = F.transform(matches, lambda m: F.substring(m, -NEAR, NEAR))
    zipped = F.zip_with(zipped, F.concat(none, ends), lambda x, p: F.struct(x["m"].alias("m"), x["g"].alias("g"), x["h"].alias("h"), x["next"].alias("next"), p.alias("prev")))
    zipped = F.slice(zipped, F.lit(1), n)

    def add(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["g"])
        before = F.substring(F.concat(x["prev"], F.substring(x["g"], -NEAR, NEAR)), -NEAR, NEAR)
        made = item(start, x["m"], before, F.substring(F.concat(F.substring(x["h"], 1, NEAR), x["next"]), 1, NEAR))
        items = F.when(made.isNotNull(), F.concat(state["items"], F.array(made))).otherwise(state["items"])
        return F.struct((start + F.length(x["m"])).cast("long").alias("at"), items.cast(empty).alias("items"))

    def whole(z: Column) -> Column:
        """Items of all matches, run by run of ``RUN`` matches, so that no growing array is copied for each of them."""
        runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(z) - 1) / RUN).cast("int")), lambda i: F.slice(z, i * RUN + 1, F.lit(RUN)))
        return _let(runs, lambda r: _let(_offsets(r), lambda at: F.flatten(F.zip_with(r, at, lambda run, first: F.aggregate(
            run, F.struct(first.alias("at"), F.array().cast(empty).alias("items")), add, lambda s: s["items"])))))

    found = F.when(n > 0, _let(zipped, whole))
    return F.coalesce(found, F.array().cast(empty))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _offsets(runs: Column) -> Column:
    """Where the first text of each run starts: the lengths of the runs before it, added up."""
    sizes = F.transform(runs, lambda run: F.aggregate(run, F.lit(0).cast("long"), lambda t, x: t + F.length(x["g"]) + F.length(x["m"])))
    return F.aggregate(sizes, F.array(F.lit(0).cast("long")), lambda done, n: F.concat(done, F.array(F.element_at(done, -1) + n)), lambda done: F.slice(done, F.lit(1), F.size(done) - 1))


def base_spans(text: Column) -> Column:
    """The spans of the fixed patterns, kind by kind."""

    def one(number: int, kind: str) -> Column:
        pattern, sign, keep = RULES[kind]

        def item(start, m, gap, behind):
            span = F.struct(start.cast("long").alias("start"), F.lit(number).alias("no"), (start + F.length(m)).cast("long").alias("end"), F.lit(kind).alias("kind"))
            return F.when(keep(m), span) if keep else span

        found = _collected(text, pattern, kind, item, SPAN)
        return F.when(F.contains(text, F.lit(sign)), found).otherwise(F.array().cast(SPAN)) if sign else found

    return F.concat(*[one(n, k) for n, k in enumerate(KINDS)])


def _plain(words: Column) -> Column:
    """Words of a context: lower case, single blanks, each digit as 0."""
    return F.translate(F.regexp_replace(F.lower(F.trim(words)), r"\s+", " "), "123456789", "0" * 9)


def tokens(text: Column) -> Column:
    """Digit groups with single blanks between them, taken together, and other words that hold a digit or an at sign, without the signs around
    them; and up to ``WORDS`` words on both sides. ``START`` stands on the left of a text's first word."""

    def item(start, m, before, behind):
        core = F.regexp_extract(m, r"[A-Za-z0-9@+(](?:.*[A-Za-z0-9])?", 0)
        lead = F.length(F.regexp_extract(m, r"^[^A-Za-z0-9@+(]*", 0))
        words = _plain(F.regexp_extract(before, rf"(?:(?<!\S)\S+\s+){{1,{WORDS}}}$", 0))
        left = F.when((words == "") & (F.length(before) == start), F.lit(START)).otherwise(words)
        right = _plain(F.regexp_extract(behind, rf"^(?:\s+\S+){{1,{WORDS}}}", 0))
        at = (start + lead).cast("long")
        made = F.struct(at.alias("start"), (at + F.length(core)).alias("end"), core.alias("value"), left.alias("left"), right.alias("right"))
        return F.when((F.length(core) >= 5) & (F.length(core) <= 4 * NEAR), made)

    return _collected(text, TOKEN, "token", item, FOUND)


def _shape(kind: str, value: Column) -> Column:
    """Whether a value looks like one of the kind, whatever the fixed pattern says."""
    n = F.length(_digits(value))
    return {
        "email": value.rlike(r"^[^@]+@[^@]+$"),
        "ip": value.rlike(r"^[0-9]+(?:\.[0-9]+){2,}(?::[0-9]+)?$"),
        "card": value.rlike(r"^[0-9]+(?:[ -][0-9]+)*$") & n.between(12, 19),
        "phone": value.rlike(r"^[+(]?[0-9][0-9() .-]+$") & n.between(7, 15) & ~value.rlike(r"^[0-9]+(?:\.[0-9]+){2,}$"),
    }[kind]


def _occurrences(read: DataFrame) -> DataFrame:
    """``row, kind, start, end, value, left, right, known``: each shaped token, whatever is around it, and whether a fixed pattern has it.

    A token is known if it has more than half of a base span; one that has less of it is a part of it and no value of its own. Cards and phones are
    the same value however their digits are grouped."""
    rows = read.select("row", "base", F.explode("tokens").alias("t")).select("row", "base", "t.*")
    hit = F.filter("base", lambda b: (b["start"] < F.col("end")) & (b["end"] > F.col("start")))
    most = F.filter("hit", lambda b: 2 * (F.least(b["end"], F.col("end")) - F.greatest(b["start"], F.col("start"))) > b["end"] - b["start"])
    rows = rows.withColumn("hit", hit).withColumn("kinds", F.transform(most, lambda b: b["kind"]))
    rows = rows.where((F.size("hit") == 0) | (F.size("kinds") > 0))
    shaped = F.array_compact(F.array(*[F.when(_shape(k, F.col("value")), F.lit(k)) for k in KINDS]))
    kinds = F.when(F.size("kinds") > 0, F.array_distinct("kinds")).otherwise(shaped)
    rows = rows.select("row", "start", "end", "value", "left", "right", (F.size("kinds") > 0).alias("known"), F.explode(kinds).alias("kind"))
    return rows.withColumn("value", F.when(F.col("kind").isin("card", "phone"), _digits(F.col("value"))).otherwise(F.lower("value")))


def anchors(text_rows: DataFrame, occurrences: DataFrame, least_rate: float) -> DataFrame:
    """``kind, word``: words of which at least ``least_rate`` of all places in the texts are near shaped values of the kind."""
    around = F.filter(F.split(F.concat_ws(" ", "left", "right"), " "), lambda w: ~w.isin("", START))
    near = occurrences.select("kind", F.explode(around).alias("word")).groupBy("kind", "word").agg(F.count(F.lit(1)).alias("near"))
    words = text_rows.select(F.explode(F.split(F.translate(F.lower("text"), "123456789", "0" * 9), r"\s+")).alias("_word"))
    everywhere = words.groupBy("_word").agg(F.count(F.lit(1)).alias("places"))
    met = near.join(everywhere, F.col("word") == F.col("_word"))
    return met.where(F.col("near") >= least_rate * F.col("places")).select("kind", "word")


def _in_contexts(occurrences: DataFrame) -> DataFrame:
    """``kind, value, known, stem, context``: a row for each context of each occurrence. Contexts with the same side and nearest
    words share their ``stem``; what they say about a value is not independent."""
    left, right = (F.filter(F.split(side, " "), lambda w: w != "") for side in ("left", "right"))

    def side(words: Column, n: int, mark: str) -> Column:
        part = F.array_join(F.slice(words, -n, n) if mark == "left" else F.slice(words, 1, n), " ")
        return F.when(F.size(words) >= n, F.concat(part, F.lit(" _")) if mark == "left" else F.concat(F.lit("_ "), part))

    def context(stem: Column, text: Column) -> Column:
        return F.when(text.isNotNull(), F.struct(stem.alias("stem"), text.alias("context")))

    both = F.concat(side(left, 1, "left"), F.substring(side(right, 1, "right"), 2, 4 * NEAR))
    made = [context(side(left, 1, "left"), side(left, n, "left")) for n in range(1, WORDS + 1)]
    made += [context(side(right, 1, "right"), side(right, n, "right")) for n in range(1, WORDS + 1)]
    rows = occurrences.select("kind", "value", "known", F.explode(F.array_compact(F.array(*made, context(both, both)))).alias("c"))
    return rows.select("kind", "value", "known", "c.*")


def trusted_values(occurrences: DataFrame, words: DataFrame, s: Settings) -> DataFrame:
    """``kind, value, score`` of values that no fixed pattern has, after the last round; ``words`` are the :func:`anchors`.

    Only values trusted already count for a context: half-trusted ones would raise the share of the very context that they have it from."""
    edges = _in_contexts(occurrences).groupBy("kind", "context", "stem", "value").agg(F.max("known").alias("known"))
    parts = edges.select("kind", "context").distinct().withColumn("word", F.explode(F.split("context", " ")))
    anchored = parts.join(words, ["kind", "word"], "left_semi").select("kind", "context").distinct()
    edges = cut_lineage(edges.join(anchored, ["kind", "context"], "left_semi"), "pii-graph")
    scores = edges.groupBy("kind", "value").agg(F.max("known").cast("double").alias("score"))
    for _ in range(s.rounds):
        weighed = edges.join(scores, ["kind", "value"])
        contexts = weighed.groupBy("kind", "context").agg(F.sum(F.when(F.col("score") >= s.least_score, F.col("score")).otherwise(0.0)).alias("mass"), F.count(F.lit(1)).alias("n"))
        contexts = contexts.where((F.col("mass") >= s.least_values) & (F.col("mass") / F.col("n") >= s.least_share))
        contexts = contexts.select("kind", "context", F.least(F.col("mass") / F.col("n"), F.lit(0.99)).alias("share"))
        best = edges.join(contexts, ["kind", "context"], "left").groupBy("kind", "value", "stem").agg(
            F.max("known").alias("known"), F.max(F.coalesce("share", F.lit(0.0))).alias("share")
        )
        doubt = best.groupBy("kind", "value").agg(F.max("known").alias("known"), F.exp(F.sum(F.log1p(-F.col("share")))).alias("doubt"))
        scores = doubt.select("kind", "value", "known", F.when(F.col("known"), 1.0).otherwise(1 - F.col("doubt")).alias("score"))
        scores = cut_lineage(scores, "pii-scores")
    return scores.where((~F.col("known")) & (F.col("score") >= s.least_score)).select("kind", "value", "score")


def find(documents: DataFrame, settings: Settings | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, row, base, added``; spans are (start, no, end, kind) in code points, end exclusive, by start.

    ``base`` are the matches of the fixed patterns, ``added`` those that contexts give away, of kind ``context_email`` and so on. Null and
    empty texts have none; rows that repeat an id and text get the same spans; a null id is kept. ``row`` is a hash of id and text.
    Other columns are ignored. Values shorter than 5 or longer than 256 characters seed no contexts and are not added."""
    s = settings or Settings()
    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).alias("text"))
    rows = rows.withColumn("row", row_key(rows, "doc_id", "text"))
    text = F.col("text")
    seen = rows.select("doc_id", "row", base_spans(text).alias("base"), F.when(text.rlike("[0-9@]"), tokens(text)).otherwise(F.array().cast(FOUND)).alias("tokens"))
    seen = cut_lineage(seen, "pii-read")
    occurrences = _occurrences(seen)
    values = trusted_values(occurrences, anchors(rows, occurrences, s.least_rate), s).withColumnsRenamed({"kind": "_kind", "value": "_value"})
    numbers = F.create_map(*[x for n, k in enumerate(KINDS) for x in (F.lit(k), F.lit(n + len(KINDS)))])
    spans = F.struct("start", numbers[F.col("kind")].alias("no"), "end", F.concat(F.lit("context_"), "kind").alias("kind"))
    added = occurrences.where("NOT known").join(values, (F.col("kind") == F.col("_kind")) & (F.col("value") == F.col("_value")))
    added = added.groupBy(F.col("row").alias("_row")).agg(F.array_sort(F.collect_set(spans)).cast(SPAN).alias("added"))
    out = seen.select("doc_id", "row", F.array_sort("base").alias("base")).join(added, F.col("row") == F.col("_row"), "left")
    return out.select("doc_id", "row", "base", F.coalesce("added", F.array().cast(SPAN)).alias("added"))


def digest(found: DataFrame) -> DataFrame:
    """Counts per base kind, a digest of the base spans and all spans as text."""

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(k) for k in KINDS],
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(F.concat("base", "added")).alias("spans"),
    )


def masked(documents: DataFrame, settings: Settings | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``documents`` with every span of ``find`` in ``text_column`` replaced by its kind in angle brackets; overlapping spans are
    replaced as one, by the kind of the first. Null and empty texts stay as they are, and so do all other columns, whatever their names, and
    all rows, repeated ones too; an empty table stays empty."""
    key, own, marks, done = free_names(documents, "_key", "_own", "_marks", "_done")
    spans = find(documents, settings, id_column, text_column).select("row", F.array_sort(F.concat("base", "added")).alias("spans"))
    spans = spans.where(F.size("spans") > 0).dropDuplicates(["row"]).select("row", F.posexplode("spans").alias("pos", "s"))
    before = Window.partitionBy("row").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("at", F.coalesce(F.max("s.end").over(before), F.lit(0)))  # where the spans before end
    mark = F.when(F.col("s.start") >= F.col("at"), F.struct("pos", "at", "s.start", "s.kind"))
    replaced = spans.groupBy(F.col("row").alias(key)).agg(F.sort_array(F.collect_list(mark)).alias(marks), F.max("s.end").alias(done))
    text = F.col(text_column)
    # Names of the input are read before any is added, so none can be mistaken for a helper column.
    own_key = row_hash(F.col(id_column).cast("long").cast("string"), text_or_empty(text_column))
    joined = documents.withColumn(own, own_key).join(replaced, F.col(own) == F.col(key), "left")
    parts = F.transform(marks, lambda m: F.concat(F.substring(text, (m["at"] + 1).cast("int"), (m["start"] - m["at"]).cast("int")), F.lit("<"), m["kind"], F.lit(">")))
    rest = F.substring(text, (F.col(done) + 1).cast("int"), F.length(text))
    new = F.when(F.col(marks).isNull() | text.isNull(), text).otherwise(F.concat(F.array_join(parts, ""), rest))
    return joined.select(*[new.alias(c) if c == text_column else F.col(f"`{c}`") for c in documents.columns])
