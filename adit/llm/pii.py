r"""Personal data, and the terms that give it away.

Patterns find e-mail addresses, IP addresses, payment cards (Luhn) and phone numbers in whole
texts. Beyond them, terms (runs of letters and digits of any length, outside those spans) are
protected by what they disclose: where a term and an entity (a concrete address or number) stand
anywhere in the same text, in several different texts, and most documents of the corpus that hold
the term hold that entity, reading the term tells the entity. The disclosure of entity e by term t
is estimated from counts over all documents, a row counting as one in each of them: the share
P(e|t) = n(e,t) / n(t) and the pointwise information log2(P(e|t) / P(e)). A term beyond both
thresholds is a span wherever it stands: removed if P(e|t) is at least ``REMOVE``, else
generalised. Copies of one text alone are no evidence; scripts without spaces give long runs.

Everything is DataFrame expressions. Positions come from splitting a text at the matches and
adding up lengths. Patterns use possessive runs, so a long run of letters or digits costs its
length only. Terms meet the corpus by a broadcast join while they are few (checked), else by a
shuffled one.

Defined results: a null text counts as empty and has no spans; repeated rows give equal rows; an
empty table gives an empty result; a failing match (an IP part above 255, a wrong check digit, a
wrong number of digits) is dropped and not retried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adit.llm.common import checkpointed, table, text_of

# A run that begins inside another run is no leftmost match unless the last match ended there: \G
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    # shorter runs of digits never count; a run starts where no digit, alone or with one separator, stands before
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?+[0-9]){12,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
KINDS = tuple(PATTERNS)
RUN = r"[\p{L}\p{M}\p{N}]++"
SEPARATOR = r"[^\p{L}\p{M}\p{N}]++"
CONTEXTS = 2
SHARE = 0.5
REMOVE = 0.9
BITS = 3.0
BROADCAST_ROWS = 50_000
BROADCAST_TERMS = 300_000
SLICE = 256
_SPAN = "array<struct<start:int,end:int,value:string>>"


def _for(kind: str, make):
    """A lambda of one parameter, as array functions take it, that knows its kind."""
    return lambda span: make(kind, span)


def _once(value: Column, make) -> Column:
    """``make`` of a value that is computed once: a lambda inside would compute it for each of its elements."""
    return F.get(F.transform(F.array(value), make), F.lit(0))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def holds(kind: str, value: Column) -> Column:
    """Whether a match of the kind's pattern counts."""
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda part: F.length(F.ltrim(part, F.lit("0"))) <= 3) & F.forall(
            F.split(value, r"\."), lambda part: F.coalesce(F.substring(F.ltrim(part, F.lit("0")), 1, 4).try_cast("int"), F.lit(0)) <= 255
        )
    if kind == "card":
        d = _digits(value)
        return F.when(F.length(d).between(13, 19), _luhn(d)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def located(found: Column, pieces: Column) -> Column:
    """Matches with their places, from the matches and the pieces of the text between them.

    Lengths are added up within slices of ``SLICE`` matches and then over slices, as an array
    that grows one by one would cost the square of its size.
    """
    span = lambda start, m: F.struct(start.alias("start"), (start + F.length(m)).alias("end"), m.alias("value"))
    nothing = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        return F.struct((start + F.length(x["m"])).alias("at"), F.array_append(acc["spans"], span(start, x["m"])).alias("spans"))

    def shifted(acc: Column, part: Column) -> Column:
        moved = F.transform(part["spans"], lambda s: span(s["start"] + acc["at"], s["value"]))
        return F.struct((acc["at"] + part["at"]).alias("at"), F.array_append(acc["parts"], moved).alias("parts"))

    def places(steps: Column) -> Column:
        firsts = F.sequence(F.lit(1), F.greatest(F.size(steps), F.lit(1)), F.lit(SLICE))
        parts = F.transform(firsts, lambda k: F.aggregate(F.slice(steps, k, F.lit(SLICE)), nothing, step))
        whole = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("parts"))
        return F.aggregate(parts, whole, shifted, lambda acc: F.flatten(acc["parts"]))

    steps = F.transform(found, lambda m, i: F.struct(m.alias("m"), F.length(F.get(pieces, i)).alias("gap")))
    return F.get(F.transform(F.array(steps), places), F.lit(0))  # binds the steps: computed once


def base_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, email, ip, card, phone``: the spans (start, end, value) of each kind."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    may = {"email": F.contains(F.col("text"), F.lit("@")), "phone": F.contains(F.col("text"), F.lit("+"))}
    none = F.array().cast("array<string>")
    rows = rows.withColumns({f"{k}_found": F.when(may.get(k, F.lit(True)), F.regexp_extract_all("text", F.lit(p), F.lit(0))).otherwise(none) for k, p in PATTERNS.items()})
    rows = rows.withColumns({f"{k}_pieces": F.when(F.size(f"{k}_found") > 0, F.split("text", p, -1)) for k, p in PATTERNS.items()})
    # matches that do not count still use up their text: places first, the test after
    places = lambda k: _once(F.struct(F.col(f"{k}_found").alias("found"), F.col(f"{k}_pieces").alias("pieces")), lambda x: located(x["found"], x["pieces"]))
    rows = rows.withColumns({k: F.when(F.size(f"{k}_found") > 0, F.filter(places(k), _for(k, lambda k, s: holds(k, s["value"])))).otherwise(F.array().cast(_SPAN)) for k in KINDS})
    return rows.select("doc_id", "text", *KINDS)


def words(text: Column) -> Column:
    """Runs of letters, marks and digits, of any length."""
    return F.regexp_extract_all(text, F.lit(RUN), F.lit(0))


def masked() -> Column:
    """The text with its base spans turned to spaces, so that places stay what they are."""
    spans = F.array_sort(F.concat(*[F.col(k) for k in KINDS]))

    def add(acc: Column, s: Column) -> Column:
        start, end = F.greatest(s["start"], acc["at"]), F.greatest(s["end"], acc["at"])
        gap = F.substring("text", acc["at"] + 1, start - acc["at"])
        return F.struct(end.alias("at"), F.concat(acc["out"], gap, F.repeat(F.lit(" "), end - start)).alias("out"))

    done = F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), add, lambda acc: F.concat(acc["out"], F.substring("text", acc["at"] + 1, F.length("text"))))
    return F.when(F.size(spans) > 0, done).otherwise(F.col("text"))


def distinct_words(text: Column) -> Column:
    """The distinct words of a text, in lower case."""
    fast = F.split(F.lower(text), SEPARATOR, -1)
    # a capital sigma ends words in a form of its own: there words are lowered one by one, as spans are
    lowered = F.when(F.contains(text, F.lit("\u03a3")), F.transform(words(text), F.lower)).otherwise(fast)
    return F.array_remove(F.array_distinct(lowered), "")


def entities() -> Column:
    """The distinct entities of a text."""
    return F.array_distinct(F.flatten(F.array(*[F.transform(F.col(k), _for(k, lambda k, s: F.concat(F.lit(f"{k}:"), F.lower(s["value"])))) for k in KINDS])))


def _few(df: DataFrame, rows: int) -> bool:
    return df.limit(rows + 1).count() <= rows


def _semi(df: DataFrame, wanted: DataFrame, key: str, broadcast_rows: int) -> DataFrame:
    return df.join(F.broadcast(wanted) if _few(wanted, broadcast_rows) else wanted, key, "left_semi")


def by_documents(items: DataFrame, name: str) -> DataFrame:
    """``name, n, low, high, set`` of ``digest, name``: how many rows hold an item, and which texts.

    Items of one ``set`` stand in the same texts: the rows are counted, and two hashes of each one's
    digest added up, by halves that cannot overflow.
    """
    halves = [x for seed in (1, 2) for h in [F.xxhash64("digest", F.lit(seed))] for x in (h.bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(h, 32))]
    sums = [F.sum(x).alias(f"s{k}") for k, x in enumerate(halves)]
    counted = items.groupBy(name).agg(F.count(F.lit(1)).alias("n"), F.min("digest").alias("low"), F.max("digest").alias("high"), *sums)
    return counted.select(name, "n", "low", "high", F.concat_ws(":", "n", *[f"s{k}" for k in range(len(sums))]).alias("set"))


def _classes(
    rows: DataFrame, contexts: int = CONTEXTS, share: float = SHARE, bits: float = BITS, broadcast_rows: int = BROADCAST_TERMS
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Terms with the classes of entities that they disclose, the classes' entities, and the documents
    that may hold these terms: ``term, set, share, bits, removed``; ``entity, set``; ``doc_id, digest, term``."""
    digest, one = F.xxhash64("text").alias("digest"), F.count(F.lit(1))
    # what stands in one text only has one piece of evidence: dropped before anything is paired
    several = (F.col("low") != F.col("high")) if contexts > 1 else F.lit(True)
    held = rows.where(F.size("email") + F.size("ip") + F.size("card") + F.size("phone") > 0)
    held = checkpointed(held.select(digest, "text", distinct_words(masked()).alias("terms"), entities().alias("entities")))
    of_entity, of_term = held.select("digest", F.explode("entities").alias("entity")), held.select("digest", F.explode("terms").alias("term"))
    n_e = checkpointed(by_documents(of_entity, "entity").where(several).select("entity", "set", F.col("n").alias("n_e")))
    # a term's documents that hold some entity are some of its documents: they alone may show that a share is too low
    terms = checkpointed(by_documents(of_term, "term").where(several).select("term", F.col("set").alias("t_set"), F.col("n").alias("least")))
    # each set is counted by one of its members, once for each different text
    some_entity = n_e.groupBy("set", "n_e").agg(F.min("entity").alias("entity"))
    some_term = terms.groupBy("t_set", "least").agg(F.min("term").alias("term"))
    joined = lambda df, other, key: df.join(F.broadcast(other) if _few(other, broadcast_rows) else other, key)
    with_set = checkpointed(joined(of_entity, some_entity, "entity").groupBy("digest", "set", "n_e").agg(one.alias("copies")))
    near = _semi(of_term, with_set.select("digest").distinct(), "digest", broadcast_rows)
    with_term = joined(near, some_term, "term").select("digest", "t_set", "least").distinct()
    pairs = with_set.join(with_term, "digest").where(F.col("n_e") >= share * F.col("least"))
    pairs = pairs.groupBy("set", "n_e", "t_set", "least").agg(F.sum("copies").alias("n_et"), one.alias("texts"))
    pairs = pairs.where((F.col("texts") >= contexts) & (F.col("n_et") >= share * F.col("least")))
    candidates = checkpointed(pairs.select("set", "n_e", "t_set", "n_et").join(terms, "t_set").select("set", "n_e", "term", "n_et"))
    wanted = candidates.select("term").distinct()
    each = rows.select("doc_id", digest, F.explode(distinct_words(F.col("text"))).alias("term"))
    counted = lambda words, n: words.groupBy("term").agg(one.alias(n))
    if _few(wanted, broadcast_rows):
        n_all = counted(each.join(F.broadcast(wanted), "term", "left_semi"), "n_all")
    else:
        n_all = counted(each, "n_all").join(wanted, "term", "left_semi")
    # words that a document has inside its spans only do not count
    inside = counted(held.select(F.explode(F.array_except(distinct_words(F.col("text")), "terms")).alias("term")), "n_in")
    n_t = n_all.join(inside, "term", "left").select("term", (F.col("n_all") - F.coalesce("n_in", F.lit(0))).alias("n_t"))
    total = rows.agg(one.alias("total"))
    judged = candidates.join(n_t, "term").crossJoin(F.broadcast(total))  # one row
    p = F.col("n_et") / F.col("n_t")
    judged = judged.select("term", "set", p.alias("share"), F.log2(p * F.col("total") / F.col("n_e")).alias("bits"))
    judged = judged.where((F.col("share") >= share) & (F.col("bits") >= bits)).withColumn("removed", F.col("share") >= REMOVE)
    judged = checkpointed(judged)
    return judged, n_e.select("entity", "set"), _semi(each, judged.select("term").distinct(), "term", broadcast_rows)


def disclosing_terms(rows: DataFrame, **thresholds) -> tuple[DataFrame, DataFrame]:
    """Terms that disclose entities, and the documents that may hold them.

    ``rows`` as from ``base_spans``. Patterns run over them once, to find the documents with an
    entity; those (with their words) are kept for what is counted of them. Entities that stand in
    the same texts have the same figures with every term, and so have terms that stand in the same
    of these texts: sets of either are paired, not their members, by a join on the text's digest
    that takes only pairs frequent enough. A long list of addresses in two texts is one set. The
    words of all texts are read twice: to count the candidate terms, and to find the documents of
    disclosing terms. All counts are of rows. Gives ``term, entity, share, bits, removed`` and, for
    each document with such a word (inside its spans or not), ``doc_id, digest, term``.
    """
    judged, members, holding = _classes(rows, **thresholds)
    return judged.join(members, "set").select("term", "entity", "share", "bits", "removed"), holding


def general_form(term: Column) -> Column:
    return F.when(term.rlike(r"^\p{N}+$"), "[NUMBER]").when(term.rlike(r"\p{N}"), "[CODE]").otherwise("[TERM]")


def with_terms(rows: DataFrame, judged: DataFrame, holding: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``rows`` and ``term``: the places of disclosing terms outside base spans.

    ``term`` has ``start, end, value``; the value is the replacement: nothing for a removed term, else
    the term's kind (``[NUMBER]``, ``[CODE]`` with digits and letters, ``[TERM]``).
    """
    of_text = holding.join(judged.groupBy("term").agg(F.max("removed").alias("removed")), "term")
    of_text = checkpointed(of_text.select("digest", "term", "removed").distinct())
    none = F.array().cast(_SPAN)
    if of_text.isEmpty():
        return rows.select("doc_id", "text", *KINDS, none.alias("term"))
    holds_some = _semi(rows.withColumn("digest", F.xxhash64("text")), of_text.select("digest").distinct(), "digest", broadcast_rows)
    # bound step by step: what a lambda refers to would be computed for each of its elements
    split = F.transform(F.array(masked()), lambda text: F.struct(words(text).alias("found"), F.split(text, RUN, -1).alias("pieces")))
    placed = F.flatten(F.transform(split, lambda x: located(x["found"], x["pieces"])))
    spans = holds_some.select("digest", F.explode(placed).alias("s")).withColumn("term", F.lower("s.value"))
    spans = spans.join(F.broadcast(of_text) if _few(of_text, broadcast_rows) else of_text, ["digest", "term"])
    by = F.when(F.col("removed"), "").otherwise(general_form(F.col("s.value")))
    # equal texts have equal spans: one set of them for all copies
    spans = spans.groupBy("digest").agg(F.array_sort(F.collect_set(F.struct(F.col("s.start").alias("start"), F.col("s.end").alias("end"), by.alias("value")))).alias("term"))
    spans = checkpointed(spans).withColumnRenamed("digest", "of_digest")
    both = rows.join(F.broadcast(spans) if _few(spans, broadcast_rows) else spans, F.xxhash64("text") == F.col("of_digest"), "left")
    return both.select("doc_id", "text", *KINDS, F.coalesce("term", none).alias("term"))


def term_spans(rows: DataFrame, judged: DataFrame, holding: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``doc_id, digest, terms`` of the rows with terms."""
    found = with_terms(rows, judged, holding, broadcast_rows).where(F.size("term") > 0)
    return found.select("doc_id", F.xxhash64("text").alias("digest"), F.col("term").alias("terms"))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **thresholds) -> DataFrame:
    """``doc_id, text, email, ip, card, phone, term``: all spans of every row."""
    rows = base_spans(docs, id_col, text_col)
    judged, _, holding = _classes(rows, **thresholds)
    return with_terms(rows, judged, holding)


def sanitised_text() -> Column:
    """The text with base spans generalised to their kind and terms treated.

    Of overlapping spans the one that starts first (then the longer one) counts.
    """
    base = [F.transform(F.col(k), _for(k, lambda k, s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), F.lit(f"[{k.upper()}]").alias("by")))) for k in KINDS]
    terms = F.transform("term", lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s["value"].alias("by")))
    spans = F.array_sort(F.concat(*base, terms))

    def add(acc: Column, s: Column) -> Column:
        free = s["start"] >= acc["at"]
        kept = F.concat(acc["out"], F.substring("text", acc["at"] + 1, s["start"] - acc["at"]), s["by"])
        return F.struct(F.when(free, -s["back"]).otherwise(acc["at"]).alias("at"), F.when(free, kept).otherwise(acc["out"]).alias("out"))

    nothing = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = F.aggregate(spans, nothing, add, lambda acc: F.concat(acc["out"], F.substring("text", acc["at"] + 1, F.length("text"))))
    return F.when(F.size(spans) > 0, done).otherwise(F.col("text"))


def sanitised(found: DataFrame) -> DataFrame:
    """``doc_id, text``: the texts of ``personal_data`` as they may be given away."""
    return found.select("doc_id", sanitised_text().alias("text"))


def listed(kinds: tuple[str, ...]) -> Column:
    """kind:start:end of the spans of these kinds, in this order and by start, joined by commas."""
    return F.array_join(F.flatten(F.array(*[F.transform(F.col(k), _for(k, lambda k, s: F.concat(F.lit(f"{k}:"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string")))) for k in kinds])), ",")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(listed(KINDS).cast("binary"), 256).alias("base_sha256"),
        listed((*KINDS, "term")).alias("spans"),
        F.sha2(sanitised_text().cast("binary"), 256).alias("sanitised_sha256"),
    )
