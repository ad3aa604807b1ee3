"""Personal data by base patterns and bootstrapped contexts (DataFrame functions only).

Base spans: e-mail addresses, IP addresses, card numbers (Luhn) and telephone numbers,
leftmost and non-overlapping per kind; a match that fails its test is dropped.

Bootstrapping then looks for identifiers that no base pattern describes.  An *instance* is
a base span, whole, or a token with a digit that overlaps none; a token runs on over single
blanks, brackets and hyphens while groups of digits follow, and has no greatest length.  Its
*patterns* are the contexts around it, A-Z lower-cased, digits as 0, blank runs as one blank:

* the label (letters) before ``:`` or ``=``;
* the last one, two and three words before it, with the punctuation up to it;
* the first two and three words after it; one word alone, which says little, counts
  together with the word before (``around``).

Base spans are the seeds of their kind.  The graph of patterns and instances is scored in turns:

* a pattern's score for a kind is the mean score of its distinct instances, times
  ``support / (support + DAMPING)`` with support the number of those with a score;
* an instance that is no seed takes the highest score among its patterns.

After ``rounds`` turns a pattern of at least ``confidence`` marks its instances as spans
of that kind; of several kinds the one with the highest score.  Base spans keep their kind.

Matches leave a text as rows of lengths; running sums per text turn lengths into
positions.  The graph is aggregated before it is joined: an edge is a distinct (pattern,
instance) pair, so a context or token that a third of all rows hold is one edge.  Nothing is
collected, and nothing is broadcast by hand.

Defined cases: null and empty texts have no spans; positions count code points, ends
exclusive; repeated rows are searched each; an empty table gives no rows; other columns
are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.llm.rows import fresh, lower_ascii, placed
from lotwise.session import checkpoint_dir

KINDS = ("email", "ip", "card", "phone")
CONFIDENCE, DAMPING, ROUNDS = 0.8, 0.5, 3

# The base patterns in possessive form: they match the same, in linear time and without
# recursion.  A run of the first class is entered at its start or where the last match
# ended; a card has at least 13 digits.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?+[0-9]){12,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
OCTETS = r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])?(?:\.|$)){4}$"
_TOKEN = r"[^\x00-\x20\x22'<>(),;:=]"
_OTHER = r"[^\x00-\x20\x22'<>(),;:=0-9]"  # of a token, but no digit
TOKEN = (rf"(?<!{_TOKEN})(?={_OTHER}*+[0-9]){_TOKEN}++"
         r"(?:(?<=[0-9])(?:[ -]| ?\(|\)[ -]?)[0-9]++(?:[.-][0-9]++)*+(?![\p{L}0-9]))*+")
CONTEXT_CHARS = 200
_WORD, _GAP = r"[\p{L}\p{N}_-]+", r"[^\p{L}\p{N}_-]+"
_LABEL = r"(?<![\p{L}_-])([\p{L}_-]{2,30}) ?[:=] ?[\x22'(]?$"


def _patterns(left: Column, right: Column) -> Column:
    """The contexts of one match, from the text before and after it."""
    def plain(text):
        return F.regexp_replace(F.regexp_replace(lower_ascii(text), "[0-9]+", "0"), r"\s+", " ")

    def before(n):
        return F.regexp_extract(
            left, rf"(?<![\p{{L}}\p{{N}}_-])({_WORD}(?:{_GAP}{_WORD}){{{n - 1}}}(?:{_GAP})?)$", 1)

    def after(n):
        return F.regexp_extract(right, rf"^((?:{_GAP})?{_WORD}(?:{_GAP}{_WORD}){{{n - 1}}})", 1)

    left, right = plain(left), plain(right)
    both = F.when((before(1) != "") & (after(1) != ""), F.concat(before(1), F.lit("\0"), after(1)))
    kinds = {"label": F.regexp_extract(left, _LABEL, 1),
             **{f"before{n}": before(n) for n in (1, 2, 3)},
             **{f"after{n}": after(n) for n in (2, 3)}, "around": F.coalesce(both, F.lit(""))}
    named = F.array(*[F.when(x != "", F.concat(F.lit(f"{name}\0"), x))
                      for name, x in kinds.items()])
    return F.filter(named, lambda x: x.isNotNull())


def _pieces(text: Column, pattern: str, kind: str, likely: Column) -> Column:
    """Array of (kind, nth, gap, value, left, right) of all matches; ``gap`` is the length of
    the text between the last match and this one, ``left`` and ``right`` are the text around."""
    values = F.regexp_extract_all(text, F.lit(f"({pattern})"), 1)
    # Pieces: the gap before the first match, the match, the next gap and so on.
    zipped = F.arrays_zip(values.alias("value"), F.split(text, pattern, -1).alias("gap"))

    def row(pair, m, i):
        # Each match has a word at least, so three of them hold three words of context.
        def piece(j):
            return F.coalesce(F.get(pair, j)["gap"], F.lit("")), \
                F.coalesce(F.get(pair, j)["value"], F.lit(""))

        earlier = [x for j in (3, 2, 1) for x in piece(i - j)]
        later = [x for j in (1, 2, 3) for x in piece(i + j)]
        return F.struct(
            F.lit(kind).alias("kind"), i.alias("nth"), F.length(m["gap"]).alias("gap"),
            m["value"].alias("value"),
            F.right(F.concat(*earlier, m["gap"]), F.lit(CONTEXT_CHARS)).alias("left"),
            F.left(F.concat(*later), F.lit(CONTEXT_CHARS)).alias("right"))

    # The last gap follows the last match.  The array is bound once, for its neighbours.
    rows = F.flatten(F.transform(F.array(zipped), lambda pair: F.transform(
        F.filter(pair, lambda m: m["value"].isNotNull()), lambda m, i: row(pair, m, i))))
    return F.when(likely, rows).otherwise(F.array().cast(
        "array<struct<kind:string,nth:int,gap:int,value:string,left:string,right:string>>"))


def _matches(texts: DataFrame) -> DataFrame:
    """``row_id, kind, start, end, value, patterns`` of all matches, tokens included."""
    text = F.col("text")
    likely = {"email": text.contains("@"), "ip": text.rlike(r"[0-9]\.[0-9]"),
              "card": text.rlike(PATTERNS["card"]), "phone": text.contains("+"),
              "token": text.rlike("[0-9]")}
    found = F.concat(*[_pieces(text, {**PATTERNS, "token": TOKEN}[kind], kind, ok)
                       for kind, ok in likely.items()])
    rows = (texts.where(text.rlike("[0-9@]"))
            .select("row_id", F.explode(found).alias("m")).select("row_id", "m.*")
            .withColumn("patterns", _patterns(F.col("left"), F.col("right"))))
    through = (Window.partitionBy("row_id", "kind").orderBy("nth")
               .rowsBetween(Window.unboundedPreceding, 0))
    size = F.length("value")
    # A full stop after a token is no part of it.
    value = F.when(F.col("kind") == "token", F.rtrim("value", F.lit(".!?"))).otherwise(F.col("value"))
    return (rows.withColumn("end", F.sum(F.col("gap") + size).over(through).cast("int"))
            .withColumn("start", F.col("end") - size).withColumn("value", value)
            .select("row_id", "kind", "start", (F.col("start") + size).alias("end"), "value",
                    "patterns"))


def _valid(kind: Column, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    n = F.length(digits)
    return (F.when(kind == "email", True)
            .when(kind == "ip", value.rlike(OCTETS))
            .when(kind == "card", n.between(13, 19) & F.call_function("luhn_check", digits))
            .when(kind == "phone", n.between(9, 15)))


def _instances(found: DataFrame) -> DataFrame:
    """Valid base spans, and the tokens that overlap none of them."""
    token = F.col("kind") == "token"
    spans = Window.partitionBy("row_id").orderBy("start")
    last = F.max(F.when(~token, F.col("end"))).over(
        spans.rangeBetween(Window.unboundedPreceding, 0))
    next_ = F.min(F.when(~token, F.col("start"))).over(
        spans.rangeBetween(0, Window.unboundedFollowing))
    return (found.where(token | _valid(F.col("kind"), F.col("value")))
            .withColumns({"last": last, "next": next_})
            .where(~token | (F.coalesce(F.col("last") <= F.col("start"), F.lit(True))
                             & F.coalesce(F.col("next") >= F.col("end"), F.lit(True))))
            .drop("last", "next"))


def score_patterns(edges: DataFrame, seeds: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``pattern, kind, score`` from distinct ``pattern, instance`` and ``instance, kind``."""
    sizes = edges.groupBy("pattern").agg(F.count("*").alias("n"))
    given = seeds.select("instance", "kind", F.lit(1.0).alias("score")).checkpoint()
    known = given
    for turn in range(rounds):
        support = F.count("*")
        scores = (edges.join(known, "instance").groupBy("pattern", "kind")
                  .agg(F.sum("score").alias("total"), support.alias("support"))
                  .join(sizes, "pattern")
                  .select("pattern", "kind", (F.col("total") / F.col("n") * F.col("support")
                                              / (F.col("support") + DAMPING)).alias("score"))
                  .checkpoint())
        if turn + 1 < rounds:
            spread = (edges.join(scores, "pattern").groupBy("instance", "kind")
                      .agg(F.max("score").alias("score"))
                      .join(given.select("instance").distinct(), "instance", "left_anti"))
            known = given.unionByName(spread)
    return scores


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             confidence: float = CONFIDENCE, rounds: int = ROUNDS) -> DataFrame:
    """One row per row of ``docs``: ``row_id, doc_id, spans``, an array of (kind number,
    start, end, base) in that order; ``KINDS`` names the kinds.  ``row_id`` is the row's
    place (``rows.placed``)."""
    checkpoint_dir(docs.sparkSession)
    row = fresh(docs, "row_id")
    numbered = placed(docs, row).select(F.col(row).alias("row_id"), F.col(id_col).alias("doc_id"),
                           F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    spans = _instances(_matches(numbered.select("row_id", "text"))).checkpoint()
    token = F.col("kind") == "token"
    base = spans.where(~token).select("row_id", "kind", "start", "end")

    edges = spans.select(F.explode("patterns").alias("pattern"),
                         F.col("value").alias("instance")).distinct()
    seeds = spans.where(~token).select(F.col("value").alias("instance"), "kind").distinct()
    scores = score_patterns(edges.checkpoint(), seeds, rounds)
    trusted = (scores.where(F.col("score") >= confidence).groupBy("pattern")
               .agg(F.max(F.struct("score", "kind")).alias("best")))
    more = (spans.where(token)
            .select("row_id", "start", "end", F.explode("patterns").alias("pattern"))
            .join(trusted, "pattern").groupBy("row_id", "start", "end")
            .agg(F.max("best")["kind"].alias("kind")))

    number = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int") - 1
    spans = (base.withColumn("base", F.lit(True))
             .unionByName(more.withColumn("base", F.lit(False)))
             .groupBy("row_id")
             .agg(F.sort_array(F.collect_list(F.struct(
                 number.alias("kind"), "start", "end", "base"))).alias("spans")))
    none = F.array().cast("array<struct<kind:int,start:int,end:int,base:boolean>>")
    return (numbered.select("row_id", "doc_id").join(spans, "row_id", "left")
            .select("row_id", "doc_id", F.coalesce("spans", none).alias("spans")))
