"""Personal data: weak supervision over candidate spans, in column expressions only.

Base spans are fixed patterns with fixed tests (checksum, range, number of digits). Candidates are the base spans, matches that fail the
tests, and matches of looser patterns: addresses with the sign spelt out, numbers without a country code, and credentials.
Three labelers vote yes, no or nothing on each candidate: the pattern's own test, a gazetteer (top-level domains, issuers'
leading digits, country codes, reserved addresses), and the words before it, back to the candidate before. Expectation-maximisation
over the counted vote patterns, of which there are a bounded number, estimates each labeler's reliability by kind; the
posteriors train a naive Bayes classifier over votes and shape. It adds looser matches that it accepts and that overlap no
base span. A match that fails its kind's test is evidence for the training but is never added; base spans always stay.

Patterns are written so that a regular-expression engine reads each text once: possessive repeats, and no start
within a run that has failed from its first character. Places are running sums over the matches of a text, taken in
about sqrt(n) stretches of as many matches, so a text of n numbers costs n ** 1.5 small steps; overlaps are found by a
window over the spans of each text that gains any.

Rows: null and empty texts have no spans; repeated rows repeat, as spans meet their row by a number given to the row and
not by its id, so hot and null ids don't matter; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import kept, table

KINDS = ("email", "ip", "card", "phone")
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Candidates beside the base patterns: addresses with the sign spelt out, numbers without a country code, credentials.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++(?:(?:\.|\x20?[\[(]dot[\])]\x20?)[A-Za-z0-9-]++)++",
    "phone": r"(?<![0-9+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[.-][0-9]{4}(?![0-9])",
    "secret": r"(?<![A-Za-z0-9_-])(?=[0-9_-]*+[A-Za-z])(?=[A-Za-z_-]*+[0-9])[A-Za-z0-9_-]{16,}+",
}
GUARD = {
    "email": "instr(_t, '@') > 0", "ip": r"_t rlike r'[0-9]\.[0-9]'", "card": r"_t rlike r'[0-9][\x20-]?[0-9]'", "phone": "instr(_t, '+') > 0",
    "loose email": r"_t rlike r'[\[(]at[\])]'", "loose phone": r"_t rlike r'[0-9]{3}[.-][0-9]{4}'",
    "loose secret": r"_t rlike r'[A-Za-z0-9_-]{16}'",
}
CUES = {
    "email": "mail|contact|kontakt|correo|courriel|write|escrib|schreib",
    "ip": r"\bip\b|host|server|address|adresse|login|client",
    "card": "card|visa|master|amex|credit|karte|tarjeta|carte|payment|iban",
    "phone": "phone|tel|call|mobile|cell|fax|ruf|llam|appel|whatsapp",
    "secret": r"pass|pwd|token|secret|api.?key|bearer|auth|credential",
}
DOMAINS = ("com", "org", "net", "edu", "gov", "io", "info", "de", "fr", "es", "uk", "eu", "it", "nl", "ch", "at", "us")
#: How well-known services' keys begin.
PREFIXES = "(AKIA|ASIA|gh[pousr]_|glpat-|xox[abp]-|sk-|AIza)"
#: Characters before a candidate that the context labeler reads.
CONTEXT = 40
ACCEPT = 0.5
_HIT = "struct<kind:string,start:int,stop:int,value:string,before:string,after:string>"
_DIGITS = "regexp_replace(x.value, r'[^0-9]', '')"
#: SQL for a span x: whether it passes its kind's test. Leading zeros of a part of an address don't count.
_TEST = {
    "email": "true",
    "ip": r"forall(split(x.value, r'\.'), p -> trim(LEADING '0' FROM p) rlike '^([0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$')",
    "card": f"length({_DIGITS}) BETWEEN 13 AND 19 AND aggregate(sequence(1, length({_DIGITS})), 0, (sum, i) -> sum + CASE WHEN i % 2 = 1 THEN cast(substr({_DIGITS}, -i, 1) AS int) "
    f"ELSE cast(substr({_DIGITS}, -i, 1) AS int) * 2 - CASE WHEN cast(substr({_DIGITS}, -i, 1) AS int) > 4 THEN 9 ELSE 0 END END) % 10 = 0",
    "phone": f"length({_DIGITS}) BETWEEN 9 AND 15",
}
#: What the pattern's own test votes on looser matches: nothing, or whether letters and digits alternate in a credential.
_LOOSE_TEST = {"email": "0", "phone": "0", "secret": "CASE WHEN x.value rlike '([0-9]+[A-Za-z]+){3}' THEN 1 ELSE -1 END"}


def _bound(name: str, value: str, body: str) -> str:
    """SQL of `body`, in which `name` is `value`, computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _running(numbers: str) -> str:
    """SQL for the sums of what stands before each of a few numbers."""
    return f"aggregate({numbers}, named_struct('at', 0, 'out', cast(array() AS array<int>)), (acc, n) -> named_struct('at', acc.at + n, 'out', array_append(acc.out, acc.at))).out"


def found(kind: str, pattern: str, guard: str) -> Column:
    """All matches of a pattern in _t, leftmost and non-overlapping, with their places in code points and what stands around them."""
    lengths = "transform(b.h, (h, i) -> length(b.g[i]) + length(h))"
    stretches = "transform(sequence(0, size(l.n) - 1, l.step), c -> slice(l.n, c + 1, l.step))"
    sums = "transform(c, part -> aggregate(part, 0, (a, n) -> a + n))"
    starts = f"flatten(zip_with(c, {_running(sums)}, (part, o) -> transform({_running('part')}, p -> p + o)))"
    span = f"""named_struct('kind', '{kind}', 'start', s[i] + length(b.g[i]), 'stop', s[i] + l.n[i], 'value', h,
      'before', CASE WHEN b.g[i] = '' AND i > 0 THEN right(b.h[i - 1], 1) ELSE right(b.g[i], {CONTEXT}) END,
      'after', CASE WHEN b.g[i + 1] <> '' THEN left(b.g[i + 1], 1) WHEN i + 1 < size(b.h) THEN left(b.h[i + 1], 1) ELSE '' END)"""
    whole = _bound("l", f"named_struct('n', {lengths}, 'step', cast(ceil(sqrt(size(b.h))) AS int))", _bound("c", stretches, _bound("s", starts, f"transform(b.h, (h, i) -> {span})")))
    matches = f"named_struct('g', split(_t, r'{pattern}', -1), 'h', regexp_extract_all(_t, r'{pattern}', 0))"
    none = f"cast(array() AS array<{_HIT}>)"
    return F.expr(f"CASE WHEN {guard} THEN {_bound('b', matches, f'CASE WHEN size(b.h) > 0 THEN {whole} ELSE {none} END')} ELSE {none} END")


def gazetteer_vote() -> str:
    """SQL for a span x: 1 for yes, -1 for no, 0 for nothing."""
    domains = ", ".join(f"'{d}'" for d in DOMAINS)
    return f"""CASE x.kind
      WHEN 'email' THEN CASE WHEN lower(substring_index(regexp_replace(x.value, r'[^A-Za-z0-9.]', '.'), '.', -1)) IN ({domains}) THEN 1 ELSE 0 END
      WHEN 'ip' THEN CASE WHEN x.value rlike r'^(0|255)\\.' THEN -1 WHEN x.value rlike r'^(10|127|192\\.168)\\.' THEN 0 ELSE 1 END
      WHEN 'card' THEN CASE WHEN {_DIGITS} rlike '^(4|5[1-5]|2[2-7]|3[47]|6(011|5))' THEN 1 ELSE -1 END
      WHEN 'secret' THEN CASE WHEN x.value rlike '^([0-9a-f]+|[0-9A-F]+|{PREFIXES}.+)$' THEN 1 ELSE 0 END
      ELSE CASE WHEN x.value rlike r'^\\+(1|2[07]|3[0-9]|4[0-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])' THEN 1 WHEN x.value like '+%' THEN -1 ELSE 0 END END"""


def context_vote() -> str:
    """SQL for a span x: the words before it speak for its kind, or it is part of a longer token."""
    cue = "CASE x.kind " + " ".join(f"WHEN '{k}' THEN r'{v}'" for k, v in CUES.items()) + " END"
    glued = r"x.before rlike r'[\p{L}\p{N}_/]$' OR x.after rlike r'[\p{L}\p{N}_]' OR x.kind <> 'secret' AND (x.before rlike r'[\x22=]$' OR x.after = '\x22')"
    glued = glued.replace(r"'\x22'", "'\"'")
    return f"CASE WHEN {glued} THEN -1 WHEN lower(x.before) rlike {cue} THEN 1 ELSE 0 END"


def candidates(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds `base`, the base spans by kind and start, and `pool`, all candidates with their votes and shape."""
    df = df.withColumn("_t", F.coalesce(F.col(text_col), F.lit("")))
    for kind in KINDS:
        df = df.withColumn(f"_{kind}", found(kind, BASE[kind], GUARD[kind]))
        df = df.withColumn(f"_{kind}", F.expr(f"transform(_{kind}, x -> struct(x, {_TEST[kind]} AS good))"))
        df = df.withColumn(f"_{kind}", F.expr(f"transform(_{kind}, y -> struct(y.x, y.good AS base, CASE WHEN y.good THEN 1 ELSE -1 END AS test))"))
    for kind in LOOSE:
        df = df.withColumn(f"_loose_{kind}", found(kind, LOOSE[kind], GUARD[f"loose {kind}"]))
        df = df.withColumn(f"_loose_{kind}", F.expr(f"transform(_loose_{kind}, x -> struct(x, false AS base, {_LOOSE_TEST[kind]} AS test))"))
    df = df.withColumn("_all", F.concat(*(f"_{k}" for k in KINDS), *(f"_loose_{k}" for k in LOOSE)))
    shape = "concat(CASE WHEN x.value rlike r'[\\x20().-]' THEN 's' ELSE '-' END, CASE WHEN length(regexp_replace(x.value, r'[^0-9]', '')) BETWEEN 7 AND 19 THEN 'd' ELSE '-' END)"
    votes = f"named_struct('kind', x.kind, 'start', x.start, 'stop', x.stop, 'base', y.base, 'test', y.test, 'gazetteer', {gazetteer_vote()}, 'context', {context_vote()}, 'shape', {shape})"
    df = df.withColumn("base", F.expr("transform(filter(_all, y -> y.base), y -> struct(y.x.kind, y.x.start, y.x.stop))"))
    df = df.withColumn("pool", F.expr(f"transform(_all, y -> {_bound('x', 'y.x', votes)})"))
    return df.drop("_t", "_all", *(f"_{k}" for k in KINDS), *(f"_loose_{k}" for k in LOOSE))


_VOTES = ("test", "gazetteer", "context")


def reliabilities(counts: list[tuple[tuple[int, ...], float]], rounds: int = 50) -> dict[tuple[int, ...], float]:
    """The posterior of yes for each vote pattern of one kind, by expectation-maximisation of a two-class model.

    Votes are independent given the class; a labeler starts as right in four votes of five.
    """
    share, table_ = 0.5, [{c: {v: 0.8 if v == c else 0.1 if v == -c else 0.1 for v in (-1, 0, 1)} for c in (1, -1)} for _ in _VOTES]
    post: dict[tuple[int, ...], float] = {}
    for _ in range(rounds):
        for votes, _n in counts:
            yes = share * math.prod(t[1][v] for t, v in zip(table_, votes, strict=True))
            no = (1 - share) * math.prod(t[-1][v] for t, v in zip(table_, votes, strict=True))
            post[votes] = yes / (yes + no)
        total = sum(n for _, n in counts)
        share = min(0.99, max(0.01, (sum(n * post[v] for v, n in counts) + 1) / (total + 2)))
        for k, t in enumerate(table_):
            for c in (1, -1):
                mass = {x: sum(n * (post[v] if c == 1 else 1 - post[v]) for v, n in counts if v[k] == x) for x in (-1, 0, 1)}
                # As many pseudo-counts for the start as keep the classes from changing places.
                prior = {x: 8 if x == c else 1 for x in (-1, 0, 1)}
                whole = sum(mass.values()) + sum(prior.values())
                t[c] = {x: (mass[x] + prior[x]) / whole for x in (-1, 0, 1)}
    return post


def train(pools: DataFrame) -> dict[str, float]:
    """Log-odds of the span classifier by 'kind', 'kind:feature=value'; learnt from counted patterns only."""
    pattern = ["kind", *_VOTES, "shape"]
    # At most 5 kinds x 27 vote patterns x 4 shapes.
    rows = pools.select(F.explode("pool").alias("x")).select("x.*").groupBy(*pattern).count().collect()
    odds: dict[str, float] = {}
    for kind in (*KINDS, "secret"):
        own = [r for r in rows if r["kind"] == kind]
        votes: dict[tuple[int, ...], float] = defaultdict(float)
        for r in own:
            votes[tuple(r[v] for v in _VOTES)] += r["count"]
        post = reliabilities(sorted(votes.items()))
        mass: dict[str, list[float]] = defaultdict(lambda: [0.5, 0.5])
        total = [1.0, 1.0]
        for r in own:
            p = post[tuple(r[v] for v in _VOTES)]
            for side, m in enumerate((p, 1 - p)):
                total[side] += m * r["count"]
                for f in (*_VOTES, "shape"):
                    mass[f"{kind}:{f}={r[f]}"][side] += m * r["count"]
        odds[kind] = math.log(total[0] / total[1])
        for f, (yes, no) in mass.items():
            odds[f] = math.log(yes / total[0]) - math.log(no / total[1])
    return odds


def private_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, base, added): spans (kind, start, stop), by kind and start."""
    rows = kept(candidates(df.select(id_col, text_col), text_col).drop(text_col).withColumn("_row", F.monotonically_increasing_id()))
    odds = train(rows)
    # A one-row literal: some hundred numbers.
    entry = F.create_map(*(x for k, v in sorted(odds.items()) for x in (F.lit(k), F.lit(v))))
    feature = " + ".join(f"coalesce(odds[concat(x.kind, ':{f}=', x.{f})], 0D)" for f in (*_VOTES, "shape"))
    accepted = f"NOT x.base AND x.test >= 0 AND odds[x.kind] + {feature} >= {math.log(ACCEPT / (1 - ACCEPT))}D"
    gaining = rows.withColumn("odds", entry).withColumn("some", F.expr(f"filter(pool, x -> x.base OR {accepted})")).where("exists(some, x -> NOT x.base)")
    spans = gaining.select("_row", F.explode("some").alias("x")).select("_row", "x.kind", "x.start", "x.stop", "x.base")
    reach = "max(CASE WHEN base THEN stop END) OVER (PARTITION BY _row ORDER BY start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    follow = "min(CASE WHEN base THEN start END) OVER (PARTITION BY _row ORDER BY start ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    free = spans.select("*", F.expr(reach).alias("reach"), F.expr(follow).alias("follow")).where("NOT base AND coalesce(reach, 0) <= start AND coalesce(follow, stop) >= stop")
    added = free.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("kind", "start", "stop"))).alias("added"))
    none = F.expr("cast(array() AS array<struct<kind:string,start:int,stop:int>>)")
    return rows.select(id_col, "base", "_row").join(added, "_row", "left").select(id_col, "base", F.coalesce("added", none).alias("added"))


def written(spans: str) -> str:
    order = "CASE x.kind " + " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(KINDS)) + f" ELSE {len(KINDS)} END"
    keyed = f"array_sort(transform({spans}, x -> struct({order} AS k, x.start AS a, x.stop AS b, x.kind AS kind)))"
    return f"array_join(transform({keyed}, x -> concat(x.kind, ':', x.a, ':', x.b)), ',')"


def op6_private(spark, sf_dir):
    found_ = private_spans(table(spark, sf_dir, "documents"))
    counts = [F.expr(f"cast(size(filter(base, x -> x.kind = '{k}')) AS long)").alias(f"n_{k}") for k in KINDS]
    return found_.select("doc_id", *counts, F.sha2(F.expr(written("base")), 256).alias("base_sha256"), F.expr(written("concat(base, added)")).alias("spans"))
