"""Personal data by weak supervision (operator 1), DataFrame functions only.

1. One pass over the texts finds spans. Base spans: email, ip, card, phone by
   their patterns and checks (leftmost, non-overlapping per kind; a match that
   fails its check is dropped). Further candidates come from looser patterns:
   disguised emails, phone numbers without a plus, digit groups, credentials.
   Only spans and a few characters around them are kept; texts go no further.
2. Labelers vote on every candidate (1 personal, -1 not, 0 no opinion):
   pattern and checksum, gazetteers (top-level domains, reserved networks,
   issuer prefixes), words before the span, shape of the surroundings.
3. Expectation-maximisation over the counts of vote patterns estimates, per
   kind, how often each labeler is right, and the share of personal spans. The
   counts are an aggregate of at most 3**4 rows per kind.
4. A logistic classifier is trained on the candidates' features (votes, kind,
   length, neighbouring characters), with the estimated probabilities as
   targets, from counts per feature pattern; candidates it accepts are added.
   Base spans always stay.

A span is found by wrapping matches in U+0001 and splitting there (U+0001 in
a text is first replaced by U+0002, which no pattern matches either), so
positions are running sums of lengths, in code points. Running sums, maxima and
minima over an array are taken in chunks of ``CHUNK`` whose totals are summed
up the same way, so their cost is linear in the matches of a text; spans of the
two lists that overlap are found by one sort and two running extremes.
Possessive quantifiers and look-behinds state the same matches without
backtracking over long runs.

Defined results: null texts are empty; an empty or clean text has the hash of
an empty string and no spans; overlapping spans of different kinds all stay;
added spans that overlap a base span are left out. Rows keep their
multiplicity; other columns are never read.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomrate.llm.common import staged

# Fixed patterns of the base kinds. (?<!...) and \G let a match begin only
# where no earlier start could have matched.
_LOCAL, _DOMAIN = "A-Za-z0-9._%+-", "A-Za-z0-9-"
BASE = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[{_DOMAIN}]++(?:\.[{_DOMAIN}]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# Looser patterns; the kinds that they propose.
LOOSE = {
    "email": rf"(?<![{_LOCAL}])[A-Za-z0-9][{_LOCAL}]{{0,63}}+ ?(?:@|\(at\)|\[at\]|\{{at\}}) ?"
             rf"[A-Za-z0-9-]++(?: ?(?:\.|\(dot\)|\[dot\]|\{{dot\}}) ?[A-Za-z0-9-]++)++",
    "phone": r"(?<![0-9A-Za-z.+-])(?<![+][0-9]{1,3} )\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z-])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "secret": r"(?i)(?<![a-z0-9])(?:api[_-]?key|access[_-]?key|secret|token|password|passwd|pwd)"
              r" {0,2}[=:] {0,2}[\"']?[a-z0-9/+_.-]{12,}+",
}
KINDS = ("email", "ip", "card", "phone", "ssn", "iban", "secret")
# Gazetteers.
DOMAINS = ("com org net edu gov mil int info biz io co ai app dev me us uk de fr es it nl be ch at pl se "
           "no dk fi pt ie eu ca au nz jp cn in br mx ru za kr")
CONTEXT = {
    "email": "mail e-mail email contact write address reach",
    "ip": "ip host server address addr from client login",
    "card": "card visa mastercard amex credit debit payment pay number",
    "phone": "phone tel telephone call fax mobile cell contact whatsapp",
    "ssn": "ssn social security",
    "iban": "iban account bank transfer",
    "secret": "token key secret password passwd pwd api",
}
AGAINST = "version ver release isbn order invoice issue ticket section chapter page sku serial build"
AROUND = 32
#: Values of a running total's chunk, and how often chunks are chunked again.
CHUNK, LEVELS = 64, 4
EM_ROUNDS, GD_ROUNDS, GD_RATE, L2 = 60, 400, 0.5, 1e-3
LABELERS = ("pattern", "gazetteer", "context", "shape")
_SPAN = "array<struct<kind:string,start:int,end:int,value:string,before:string,after:string,base:boolean>>"


def _once(value: Column, use) -> Column:
    """``use(value)``, an array, with the value found once and bound to a name."""
    return F.flatten(F.transform(F.array(value), use))


def running(values: Column, add, none: Column, level: int = LEVELS) -> Column:
    """For each place of an array of ints (of ``none`` if there is nothing),
    the total of the values up to and with it. ``add`` is associative."""

    def plain(xs):
        return F.slice(F.aggregate(xs, F.array(none), lambda acc, x: F.concat(
            acc, F.array(add(F.element_at(acc, -1), x)))), F.lit(2), F.greatest(F.size(xs), F.lit(1)))

    if not level:
        return plain(values)

    def chunked(xs):
        cuts = F.transform(F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / CHUNK).cast("int")),
                           lambda k: plain(F.slice(xs, k * CHUNK + 1, F.lit(CHUNK))))
        return _once(cuts, lambda own: _once(
            running(F.transform(own, lambda c: F.element_at(c, -1)), add, none, level - 1),
            lambda before: F.flatten(F.transform(own, lambda c, k: F.when(k == 0, c).otherwise(
                F.transform(c, lambda x: add(F.get(before, k - 1), x)))))))

    return _once(values, lambda xs: F.when(F.size(xs) <= CHUNK, plain(xs)).otherwise(chunked(xs)))


def spans(text: Column, pattern: str, kind: str, base: bool) -> Column:
    """Array of the pattern's matches in ``text`` (no U+0001 in it)."""
    parts = F.split(F.regexp_replace(text, pattern, "\u0001$0\u0001"), "\u0001")

    def cuts(p):
        # where each part ends; every other part is a match
        ends = running(F.transform(p, F.length), lambda a, b: a + b, F.lit(0))
        return _once(ends, lambda e: F.transform(F.sequence(F.lit(1), F.size(p) - 2, F.lit(2)), lambda i: F.struct(
            F.lit(kind).alias("kind"), F.get(e, i - 1).alias("start"), F.get(e, i).alias("end"),
            F.get(p, i).alias("value"), F.right(F.get(p, i - 1), F.lit(AROUND)).alias("before"),
            F.left(F.get(p, i + 1), F.lit(2)).alias("after"), F.lit(base).alias("base"))))

    return _once(parts, lambda p: F.when(F.size(p) > 1, cuts(p)).otherwise(F.array().cast(_SPAN)))


def without_overlap(loose: Column, base: Column) -> Column:
    """The spans of ``loose`` that overlap none of ``base``, by start: none
    that begins before ends later, none that begins inside."""
    far = F.lit((1 << 31) - 1)

    def sweep(every):
        ended = running(F.transform(every, lambda s: F.when(s["loose"], 0).otherwise(s["end"])),
                        lambda a, b: F.greatest(a, b), F.lit(0))
        nexts = F.reverse(running(
            F.transform(F.reverse(every), lambda s: F.when(s["loose"], far).otherwise(s["start"])),
            lambda a, b: F.least(a, b), far))
        both = F.array(F.struct(ended.alias("ended"), nexts.alias("nexts")))
        return F.flatten(F.transform(both, lambda r: F.transform(
            F.filter(every, lambda s, i: s["loose"] & (F.get(r["ended"], i) <= s["start"])
                     & (F.get(r["nexts"], i) >= s["end"])), lambda s: s["span"])))

    def marked(spans_, is_loose):
        return F.transform(spans_, lambda s: F.struct(
            s["start"].alias("start"), F.lit(is_loose).alias("loose"), s["end"].alias("end"), s.alias("span")))

    # a base span comes before a loose one of the same start
    return F.when((F.size(loose) == 0) | (F.size(base) == 0), loose).otherwise(
        _once(F.array_sort(F.concat(marked(base, False), marked(loose, True))), sweep))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether the digits of ``value`` pass the Luhn check."""
    d = F.reverse(_digits(value))
    odd = F.transform(F.split(d, ""), lambda x, i: F.when(i % 2 == 0, x.cast("int")).otherwise(
        F.when(x.cast("int") > 4, 2 * x.cast("int") - 9).otherwise(2 * x.cast("int"))))
    return F.aggregate(odd, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"


def valid(kind: str, value: Column) -> Column:
    """The check of a base kind."""
    if kind == "ip":
        return value.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return luhn(value)
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    return F.lit(True)


def _passes(kind: str):
    return lambda s: valid(kind, s["value"])


def _is(kind: str):
    return lambda s: s["kind"] == kind


def candidates(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, base, loose): arrays of spans of every row."""
    clean = docs.select(id_col, F.translate(F.coalesce(F.col(text_col), F.lit("")), "\u0001", "\u0002")
                        .alias("text"))
    text = F.col("text")
    digit = text.rlike("[0-9]")
    may = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+"))}
    base = [F.when(may.get(k, digit), F.filter(spans(text, p, k, True), _passes(k)))
            .otherwise(F.array().cast(_SPAN)) for k, p in BASE.items()]
    loose_may = {"email": F.contains(text, F.lit("@")) | text.rlike(r"[(\[{]at[)\]}]"),
                 "secret": text.rlike(r"[=:]")}
    loose = [F.when(loose_may.get(k, digit), spans(text, p, k, False)).otherwise(F.array().cast(_SPAN))
             for k, p in LOOSE.items()]
    found = clean.select(id_col, F.concat(*base).alias("base"), F.concat(*loose).alias("loose"))
    # what overlaps a base span adds nothing
    return found.select(id_col, "base", without_overlap(F.col("loose"), F.col("base")).alias("loose"))


def _words(words: str) -> str:
    return r"(?i)(?:^|[^a-z])(?:" + "|".join(words.split()) + r")(?:$|[^a-z])"


def votes(s: Column) -> Column:
    """Struct of the labelers' votes on a span."""
    kind, value, before, after = s["kind"], s["value"], s["before"], s["after"]
    yes, no, none = F.lit(1), F.lit(-1), F.lit(0)
    digits = _digits(value)
    pattern = (F.when(s["base"], yes)
               .when(kind == "email", F.when(value.rlike(rf"^[{_LOCAL}]+ ?[@(\[{{].*[A-Za-z]{{2,}}$"), yes)
                     .otherwise(no))
               .when(kind == "phone", F.when(digits.rlike("^[2-9][0-9]{2}[2-9]"), yes).otherwise(no))
               .when(kind == "ssn", F.when(digits.rlike("^(?:000|666|9)|^.{3}00|0000$"), no).otherwise(yes))
               .when(kind == "iban", F.when(F.length(F.regexp_replace(value, " ", "")).between(15, 34), yes)
                     .otherwise(no))
               .when(kind == "secret", F.when(value.rlike("[0-9]") & value.rlike("[A-Za-z]{2}"), yes)
                     .otherwise(no)).otherwise(none))
    gazetteer = (F.when(kind == "email", F.when(F.lower(value).rlike(
                     r"[.)\]}] ?(?:" + "|".join(DOMAINS.split()) + ")$"), yes).otherwise(no))
                 .when(kind == "ip", F.when(value.rlike(r"^(?:0|127|255)\."), no).otherwise(yes))
                 .when(kind == "card", F.when(digits.rlike("^(?:4|5[1-5]|2[2-7]|3[47]|6)"), yes).otherwise(none))
                 .when(kind == "phone", F.when(value.rlike(r"^\+0|^\(?555"), no).otherwise(yes))
                 .when(kind == "secret", F.when(F.lower(value).rlike(r"example|changeme|placeholder|xxxx"), no)
                       .otherwise(yes)).otherwise(none))
    about = F.lit(False)
    for k, words in CONTEXT.items():
        about = about | ((kind == k) & before.rlike(_words(words)))
    context = F.when(about | (kind == "secret"), yes).when(before.rlike(_words(AGAINST)), no).otherwise(none)
    joined = before.rlike(r"[A-Za-z0-9_/=]$") | after.rlike(r"^[A-Za-z0-9_/=]|^[.][0-9]")
    same = digits.rlike(r"([0-9])\1{6}") | digits.rlike("0123456789|9876543210")
    shape = F.when(joined | same, no).otherwise(yes)
    return F.struct(*[v.alias(n) for n, v in zip(LABELERS, (pattern, gazetteer, context, shape))])


def features(s: Column) -> Column:
    """Struct of the classifier's categorical features of a voted span."""
    v = s["vote"]
    length = F.least(F.floor(F.log2(F.greatest(s["end"] - s["start"], F.lit(1)))), F.lit(7)).cast("int")
    left = F.when(s["before"] == "", "edge").when(s["before"].rlike(r"\s$"), "space").otherwise("other")
    right = F.when(s["after"] == "", "edge").when(s["after"].rlike(r"^\s"), "space").otherwise("other")
    return F.struct(s["kind"].alias("kind"), length.alias("length"), left.alias("left"), right.alias("right"),
                    *[v[n].alias(n) for n in LABELERS])


def estimate(patterns: list[tuple[str, tuple[int, ...], int]]) -> dict[tuple[str, tuple[int, ...]], float]:
    """Expectation-maximisation per kind over (kind, votes, count): the
    probability that a span with these votes is personal. Begins with every
    labeler right four times in five."""
    by_kind = defaultdict(list)
    for kind, vote, n in patterns:
        by_kind[kind].append((vote, n))
    out = {}
    for kind, rows in by_kind.items():
        share = 0.5
        # right[labeler][class][vote]
        right = [({1: 0.6, 0: 0.25, -1: 0.15}, {1: 0.15, 0: 0.25, -1: 0.6}) for _ in LABELERS]
        post = {}
        for _ in range(EM_ROUNDS):
            for vote, _n in rows:
                a = math.log(share) + sum(math.log(right[i][0][x]) for i, x in enumerate(vote))
                b = math.log(1 - share) + sum(math.log(right[i][1][x]) for i, x in enumerate(vote))
                post[vote] = 1 / (1 + math.exp(max(-500.0, min(500.0, b - a))))
            total = sum(n for _, n in rows)
            share = (sum(post[v] * n for v, n in rows) + 1) / (total + 2)
            for i in range(len(LABELERS)):
                for c in (0, 1):
                    weight = {x: 0.5 for x in (1, 0, -1)}
                    for v, n in rows:
                        weight[v[i]] += n * (post[v] if c == 0 else 1 - post[v])
                    s = sum(weight.values())
                    right[i][c].update({x: w / s for x, w in weight.items()})
        out.update({(kind, v): p for v, p in post.items()})
    return out


def train(rows: list[tuple[list[str], float, int]]) -> dict[str, float]:
    """Weights of a logistic model over named features, from (features,
    target probability, count) rows; gradient descent."""
    weights: dict[str, float] = defaultdict(float)
    total = sum(n for _, _, n in rows) or 1
    for _ in range(GD_ROUNDS):
        step: dict[str, float] = defaultdict(float)
        for names, target, n in rows:
            z = sum(weights[x] for x in names)
            d = (1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - target) * n / total
            for x in names:
                step[x] += d
        for x, g in step.items():
            weights[x] -= GD_RATE * (g + L2 * weights[x])
    return dict(weights)


_NAMES = ("kind", "length", "left", "right", *LABELERS)


def _named(f: dict) -> list[str]:
    return ["bias", *[f"{k}={f[k]}" for k in _NAMES], *[f"{f['kind']}:{k}={f[k]}" for k in LABELERS]]


def _score(f: Column, weights: dict[str, float]) -> Column:
    """The model's sum for a struct of features."""
    z = F.lit(weights.get("bias", 0.0))
    table = F.create_map(*[x for k, w in sorted(weights.items()) for x in (F.lit(k), F.lit(float(w)))])
    for k in _NAMES:
        z = z + F.coalesce(table[F.concat(F.lit(k + "="), f[k].cast("string"))], F.lit(0.0))
    for k in LABELERS:
        z = z + F.coalesce(table[F.concat(f["kind"], F.lit(f":{k}="), f[k].cast("string"))], F.lit(0.0))
    return z


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, spans) of every row: arrays of (kind, start, end, value),
    base spans alone and all accepted spans."""
    found = staged(candidates(docs, id_col, text_col), "pii-candidates")
    every = F.concat("base", "loose")
    voted = found.withColumn("all", F.transform(every, lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"),
        s["before"].alias("before"), s["after"].alias("after"), s["base"].alias("base"), votes(s).alias("vote"))))
    voted = voted.withColumn("all", F.transform("all", lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"),
        s["base"].alias("base"), features(s).alias("f"))))
    voted = staged(voted.select(id_col, "all"), "pii-votes")
    # bounded: categories only (7 kinds, 8 lengths, 3 x 3 sides, 3**4 votes)
    counts = (voted.select(F.explode("all.f").alias("f")).groupBy("f").agg(F.count(F.lit(1)).alias("n")).collect())
    seen = [(r.f.asDict(), r.n) for r in counts]
    by_votes: dict[tuple, int] = defaultdict(int)
    for f, n in seen:
        by_votes[(f["kind"], tuple(f[k] for k in LABELERS))] += n
    post = estimate([(k, v, n) for (k, v), n in sorted(by_votes.items())])
    weights = train([(_named(f), post[(f["kind"], tuple(f[k] for k in LABELERS))], n)
                     for f, n in sorted(seen, key=lambda x: sorted((k, str(v)) for k, v in x[0].items()))])
    rank = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])

    def kept(which):
        own = F.transform(F.filter("all", which), lambda s: F.struct(
            s["start"].alias("start"), rank[s["kind"]].alias("rank"), s["end"].alias("end"),
            s["kind"].alias("kind"), s["value"].alias("value")))
        return F.transform(F.array_sort(own), lambda s: F.struct(
            s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))

    accepted = (lambda s: s["base"] | (_score(s["f"], weights) >= 0)) if weights else (lambda s: s["base"])
    return voted.select(id_col, kept(lambda s: s["base"]).alias("base"), kept(accepted).alias("spans"))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, the hash of the base spans and all spans as text."""
    def text(col):
        return F.array_join(F.transform(col, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    n = [F.size(F.filter("base", _is(k))).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select(id_col, *n, F.sha2(text("base"), 256).alias("base_sha256"), text("spans").alias("spans"))
