"""Secret scan in Spark expressions: three patterns, and character Markov models for the rest.

Patterns (base kinds) are matched leftmost and without overlap per kind over the whole text. On top
of them every long run of identifier characters is scored by two first-order character models, one
of random strings and one of ordinary identifiers: the log-likelihood ratio of the run, summed over
its characters, must exceed the ratio that all but a share `false_rate` of the ordinary labelled
samples stay under (and zero). Such runs are spans of kind `markov`; of a run that base spans cover in
part, each uncovered part that is long enough is scored by itself.

The models are trained from labelled samples (value, label 1 random / 0 ordinary). In a corpus
without labels `labelled_samples` takes the values of base matches as random strings and the runs
of documents without any match as ordinary ones, of all documents, each different value once.
Transition counts and the threshold are Spark aggregates; only the table of transitions, whose size
the alphabet bounds, comes to the driver. The random model is half learned
and half uniform, so that alphabets the samples lack still count as random.

Everything here is built-in functions: no Python runs on executors. Null text counts as empty. A
text without spans gets empty lists. Spans are code points, end exclusive. Arrays are built STEP entries
at a time and texts cut by blocks, so a text's cost is near its length, however many spans it has.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import numbered, pick

# Patterns of the base kinds, in listed order, and the least length each must have.
ASSIGN = (
    r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{16,}"  # a run of 20 or more; shorter runs fail as a whole
HEX = r"[0-9a-f]{24,}"
ASSIGN_VALUE = 6
KINDS = ("assign", "access", "hex", "markov")
ANY_BASE = f"{ASSIGN}|(?-i:{ACCESS})|(?-i:{HEX})"

ALPHABET = string.ascii_lowercase + string.ascii_uppercase + string.digits + "+/_=-"
RUN = r"[A-Za-z0-9+/_=-]{16,}"
ORDINARY_RUN = r"[A-Za-z0-9+/_=-]{6,}"
SPAN = "struct<kind:int,start:int,end:int,value:string>"
STEP = 256  # entries that an aggregate appends to one array
TEXT_BLOCK = 1024
LEAST_RUN = 16
FALSE_RATE = 1e-3


def matches(text: Column, pattern: str, kind: int) -> Column:
    """Array of spans (kind, start, end, matched text) of a pattern that never matches the empty
    text. Texts between matches and the matches themselves alternate, which gives the places."""
    between = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("spans"))

    def step(state, pair):
        start = state["at"] + F.length(pair["before"])
        end = start + F.length(pair["value"])
        span = F.struct(
            F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), pair["value"].alias("value")
        )
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    def shifted(state, part):
        """A step's spans, which count from its own start, behind those before it."""
        moved = F.transform(
            part["spans"],
            lambda s: F.struct(
                s["kind"].alias("kind"), (s["start"] + state["at"]).alias("start"),
                (s["end"] + state["at"]).alias("end"), s["value"].alias("value"),
            ),
        )
        return F.struct((state["at"] + part["at"]).alias("at"), F.concat(state["blocks"], F.array(moved)).alias("blocks"))

    pairs = F.zip_with(
        F.slice(between, 1, F.size(found)), found,
        lambda b, m: F.struct(b.alias("before"), m.alias("value")),
    )
    parts = F.transform(_steps(pairs), lambda part: F.aggregate(part, empty, step))
    none = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{SPAN}>>").alias("blocks"))
    spans = F.flatten(F.aggregate(parts, none, shifted)["blocks"])
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(f"array<{SPAN}>"))


def _steps(items: Column) -> Column:
    """An array cut into arrays of STEP entries."""

    def cut(array):
        last = F.floor((F.size(array) - 1) / STEP).cast("int")
        parts = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(array, k * STEP + 1, STEP))
        return F.when(F.size(array) > 0, parts).otherwise(F.slice(parts, 1, 0))

    # By way of an array of one, so that `items` is computed once and not for each of its steps.
    return F.flatten(F.transform(F.array(items), cut))


def _scan(items: Column, carry: Column, step, kind: str) -> Column:
    """What `step` (of carry and item: the next carry, an array of what it gives out) gives out, in order,
    behind it the last carry."""
    nothing = F.array().cast(f"array<{kind}>")

    def one(state, item):
        after, out = step(state["carry"], item)
        return F.struct(after.alias("carry"), F.concat(state["out"], out).alias("out"))

    def part(state, some):
        start = F.struct(state["carry"].alias("carry"), nothing.alias("out"))
        done = F.array(F.aggregate(some, start, one))
        return F.struct(
            F.element_at(F.transform(done, lambda d: d["carry"]), 1).alias("carry"),
            F.concat(state["blocks"], F.transform(done, lambda d: d["out"])).alias("blocks"),
        )

    start = F.struct(carry.alias("carry"), F.array().cast(f"array<array<{kind}>>").alias("blocks"))
    return F.aggregate(_steps(items), start, part)


def base_spans(text: Column) -> Column:
    """Spans of the three base kinds by start, then kind."""
    assigned = F.filter(
        matches(text, ASSIGN, 0),
        lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= ASSIGN_VALUE,
    )
    every = F.concat(assigned, matches(text, ACCESS, 1), matches(text, HEX, 2))
    return F.when(text.rlike(ANY_BASE), _ordered(every)).otherwise(F.array().cast(f"array<{SPAN}>"))


def _ordered(spans: Column) -> Column:
    keyed = F.transform(
        spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s.alias("span"))
    )
    return F.transform(F.array_sort(keyed), lambda s: s["span"])


def labelled_samples(docs: DataFrame) -> DataFrame:
    """(value, label), each once, from documents (doc_id, text): values of base matches, label 1, and runs
    of documents without a match, label 0. Every document and every value counts; every text is searched
    once, and a document's equal values merge before they move."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(text.alias("text"), text.rlike(ANY_BASE).alias("has"))
    hits = F.transform(
        base_spans(F.col("text")),
        lambda s: F.when(s["kind"] == 0, F.regexp_extract(s["value"], ASSIGN, 2)).otherwise(s["value"]),
    )
    runs = F.regexp_extract_all("text", F.lit(ORDINARY_RUN), F.lit(0))
    values = F.array_distinct(F.when(F.col("has"), hits).otherwise(runs))
    return rows.select(F.explode(values).alias("value"), F.col("has").cast("int").alias("label")).distinct()


def _states(value: Column) -> Column:
    """Alphabet positions (from 1; 0 for any other character) of a text's characters."""
    return F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c))


def _moves(value: Column) -> Column:
    """Transition numbers of a text: from * width + to, the start being state 0."""
    width = len(ALPHABET) + 1
    states = _states(value)
    before = F.slice(F.concat(F.array(F.lit(0)), states), 1, F.size(states))
    return F.zip_with(before, states, lambda a, b: a * width + b)


class MarkovModel:
    """Log-likelihood ratio per transition, and the ratio a run has to exceed."""

    def __init__(self, ratios: list[float], threshold: float):
        self.ratios = ratios
        self.threshold = threshold

    def score(self, value: Column) -> Column:
        """Summed log-likelihood ratio, random over ordinary, of a text."""
        table = F.split(F.lit(",".join(f"{r:.6f}" for r in self.ratios)), ",").cast("array<double>")
        return F.aggregate(
            _moves(value), F.lit(0.0), lambda total, m: total + F.element_at(table, m + 1)
        )


def train(samples: DataFrame, false_rate: float = FALSE_RATE) -> MarkovModel:
    """Model from labelled samples (value, label). Without random samples that side is uniform;
    without ordinary samples nothing scores above the threshold."""
    width = len(ALPHABET) + 1
    present = samples.where(F.col("value").isNotNull() & (F.length("value") > 0))
    counted = (
        present.select("label", F.explode(_moves(F.col("value"))).alias("move"))
        .groupBy("label", "move")
        .count()
        .collect()  # at most two rows for each transition of the alphabet
    )
    counts = [[0] * (width * width) for _ in range(2)]
    for row in counted:
        counts[row["label"]][row["move"]] = row["count"]
    ratios = [0.0] * (width * width)
    if any(counts[0]):
        for a in range(width):
            at = slice(a * width, (a + 1) * width)
            ordinary, random = counts[0][at], counts[1][at]
            o_total, r_total = sum(ordinary), sum(random)
            for b in range(width):
                plain = (ordinary[b] + 0.05) / (o_total + 0.05 * width)
                learned = (random[b] + 0.5) / (r_total + 0.5 * width)
                ratios[a * width + b] = math.log(0.5 * learned + 0.5 / width) - math.log(plain)
    model = MarkovModel(ratios, 0.0)
    usual = (
        present.where((F.col("label") == 0) & F.col("value").rlike(RUN))
        .agg(F.percentile_approx(model.score(F.col("value")), 1 - false_rate, 10_000).alias("t"))
        .first()["t"]
    )
    model.threshold = max(0.0, usual or 0.0)
    return model


def scan(docs: DataFrame, model: MarkovModel) -> DataFrame:
    """(doc_id, text, base, spans) for documents (doc_id, text): arrays of spans by start, then kind."""
    plain = pick(docs, "doc_id", "text").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return with_spans(plain, model)


def with_spans(frame: DataFrame, model: MarkovModel) -> DataFrame:
    """The frame, which has a text without nulls, with the columns base and spans."""
    based = frame.withColumn("base", base_spans(F.col("text")))
    runs = matches(F.col("text"), RUN, 3)
    open_runs = F.when(F.size("base") > 0, _uncovered(runs, F.col("base"))).otherwise(runs)
    added = F.filter(open_runs, lambda r: model.score(r["value"]) > F.lit(model.threshold))
    return based.withColumn("spans", _ordered(F.concat("base", added)))


def _uncovered(runs: Column, base: Column) -> Column:
    """The parts of runs that no base span covers, if long enough. Both by start; runs do not overlap."""
    place = "struct<start:int,sort:int,end:int,value:string>"

    def event(sort):
        return lambda s: F.struct(
            s["start"].alias("start"), F.lit(sort).alias("sort"), s["end"].alias("end"), s["value"].alias("value")
        )

    events = F.array_sort(F.concat(F.transform(base, event(0)), F.transform(runs, event(1)))).cast(f"array<{place}>")
    # What is left of the run that is open: from start to end, the run itself beginning at `at`.
    state = F.struct(
        F.lit(0).alias("covered"), F.lit(0).alias("start"), F.lit(0).alias("end"), F.lit(0).alias("at"), F.lit("").alias("value")
    )

    def part(run, end):
        span = F.struct(
            F.lit(3).alias("kind"), run["start"].alias("start"), end.alias("end"),
            F.substring(run["value"], run["start"] - run["at"] + 1, end - run["start"]).alias("value"),
        )
        return F.when(end - run["start"] >= LEAST_RUN, F.array(span)).otherwise(F.array().cast(f"array<{SPAN}>"))

    def step(run, e):
        is_run = e["sort"] == 1
        after = F.struct(
            F.when(is_run, run["covered"]).otherwise(F.greatest(run["covered"], e["end"])).alias("covered"),
            F.when(is_run, F.greatest(e["start"], run["covered"])).otherwise(F.greatest(run["start"], e["end"])).alias("start"),
            F.when(is_run, e["end"]).otherwise(run["end"]).alias("end"),
            F.when(is_run, e["start"]).otherwise(run["at"]).alias("at"),
            F.when(is_run, e["value"]).otherwise(run["value"]).alias("value"),
        )
        return after, part(run, F.when(is_run, run["end"]).otherwise(F.least(run["end"], e["start"])))

    done = F.array(_scan(events, state, step, SPAN))
    whole = F.transform(done, lambda d: F.concat(F.flatten(d["blocks"]), part(d["carry"], d["carry"]["end"])))
    return F.flatten(whole)


def redact(docs: DataFrame, model: MarkovModel, mark: str = "[secret]") -> DataFrame:
    """Documents with their secrets replaced by a mark, and n_chars (if there is one) counted anew;
    all other columns, and documents without secrets, as they were."""
    names = docs.columns
    plain = numbered(docs)
    text = f"_{names.index('text')}"
    marked = with_spans(plain.withColumn("text", F.coalesce(text, F.lit(""))), model)
    found = F.size("spans") > 0
    new = {text: F.when(found, redacted(F.col("text"), F.col("spans"), mark)).otherwise(F.col(text))}
    if "n_chars" in names:
        at = f"_{names.index('n_chars')}"
        kind = docs.schema[names.index("n_chars")].dataType
        new[at] = F.when(found, F.length(new[text]).cast(kind)).otherwise(F.col(at))
    return marked.select(*[new[c].alias(c) if c in new else F.col(c) for c in plain.columns]).toDF(*names)


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with each span replaced by a mark; spans that overlap share one."""
    blocks = F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{TEXT_BLOCK}}}"), F.lit(0))
    start = F.struct(F.lit(0).alias("at"), blocks.alias("blocks"))

    def cut(of, a, b):
        """The text from a to b: from the blocks that hold it."""
        first = F.floor(a / TEXT_BLOCK).cast("int")
        held = F.slice(of["blocks"], first + 1, F.floor((b - 1) / TEXT_BLOCK).cast("int") - first + 1)
        return F.when(b > a, F.substring(F.array_join(held, ""), a - first * TEXT_BLOCK + 1, b - a)).otherwise(F.lit(""))

    def step(state, span):
        fresh = F.array(F.concat(cut(state, state["at"], span["start"]), F.lit(mark)))
        after = F.struct(F.greatest(state["at"], span["end"]).alias("at"), state["blocks"].alias("blocks"))
        return after, F.when(span["start"] >= state["at"], fresh).otherwise(F.array().cast("array<string>"))

    done = F.array(_scan(spans, start, step, "string"))
    length = F.length(text)
    whole = F.transform(
        done, lambda d: F.concat(F.array_join(F.flatten(d["blocks"]), ""), cut(d["carry"], d["carry"]["at"], length))
    )
    return F.when(F.size(spans) > 0, F.element_at(whole, 1)).otherwise(text)
