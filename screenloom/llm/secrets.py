"""Operator 1: secrets in texts, by patterns and by a battery of randomness tests, in DataFrame functions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .columns import first_not_below, let, most_before, sums_before, total
from .common import free_name, table

#: Kind, pattern, shortest length and the group that has it.
ASSIGN = r"""(?i:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KINDS = (("assign", ASSIGN, 12, 1), ("access", "AKIA[A-Z0-9]{14,}", 18, 0), ("hex", "[0-9a-f]{16,}", 16, 0))
RANDOM = r"[A-Za-z0-9+/_-]{20,}"
#: Alphabets in order of preference, the pattern of a token written in each, and where their kinds of characters (capitals, small letters, the rest) end.
ENCODINGS = (
    ("0123456789abcdef", "^(?=.*[0-9])(?=.*[a-fA-F])([0-9a-f]+|[0-9A-F]+)$", (10, 16)),
    ("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+$", (26, 32)),
    ("0123456789abcdefghijklmnopqrstuvwxyz", "^(?=.*[0-9])(?=.*[a-zA-Z])([0-9a-z]+|[0-9A-Z]+)$", (10, 36)),
    ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z]).+$", (26, 52)),
)
HEX, BASE32, BASE36, BASE64 = range(4)
BANDS = (20, 32, 48, 80)  # shortest lengths of the bands within which false discoveries are controlled
STEPS, BINS = 8, 200  # bins of -ln p per unit, and the last one
CELL = 1  # characters that the chi-squared test expects in a cell of the alphabet, at least
DECOYS, LONGEST = 20, 160  # ordinary tokens made for each tested one, and the most characters they take
#: Words of ordinary tokens for a text that has none itself.
PLAIN_WORDS = ("value", "name", "data", "file", "user", "time", "list", "page")


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """array<struct<start, end, found, size, begin, stop>> of all leftmost non-overlapping matches.

    start and end are code points, begin and stop bytes; size is the length of the group. The pieces between matches and
    the matches themselves, in turn, make up the text, so their lengths give the places.
    """
    found, pieces = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    inner = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found

    def with_places(s: Column) -> Column:
        f, p, g = s["f"], s["p"], s["g"]
        points = sums_before(F.transform(f, lambda m, i: F.length(F.get(p, i)) + F.length(m)))
        octets = sums_before(F.transform(f, lambda m, i: F.octet_length(F.get(p, i)) + F.octet_length(m)))

        def placed(b: Column) -> Column:
            def one(m: Column, i: Column) -> Column:
                start, begin = F.get(b["points"], i) + F.length(F.get(p, i)), F.get(b["octets"], i) + F.octet_length(F.get(p, i))
                return F.struct(
                    start.alias("start"), (start + F.length(m)).alias("end"), m.alias("found"), F.length(F.get(g, i)).alias("size"),
                    begin.alias("begin"), (begin + F.octet_length(m)).alias("stop"),
                )

            return F.transform(f, one)

        return let(F.struct(points.alias("points"), octets.alias("octets")), placed)

    none = F.expr("cast(array() as array<struct<start:int,end:int,found:string,size:int,begin:int,stop:int>>)")
    return F.when(F.rlike(text, F.lit(pattern)), let(F.struct(found.alias("f"), pieces.alias("p"), inner.alias("g")), with_places)).otherwise(none)


def upper_tail(z: Column) -> Column:
    """1 - normal distribution function, by the rational approximation of erfc (error below 2e-7)."""
    x = F.abs(z) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    tail = 0.5 * poly * F.exp(-x * x)
    return F.when(z >= 0, tail).otherwise(1 - tail)


def encoding_of(token: Column) -> Column:
    """Number of the first encoding that a token's characters suggest, or null."""
    return F.coalesce(*[F.when(F.rlike(token, F.lit(p)), F.lit(i)) for i, (_, p, _) in enumerate(ENCODINGS)])


def spelt(token: Column, code: Column) -> Column:
    """A token in the characters of its encoding's alphabet."""
    return F.when(code.isin(HEX, BASE36), F.lower(token)).when(code == BASE64, F.translate(token, "-_", "+/")).otherwise(token)


def battery(plain: Column, code: Column) -> Column:
    """struct<group, bin> of a token in the characters of encoding `code`: its encoding and band of lengths, and floor(8 * -ln p).

    Under the hypothesis of uniform random characters of the alphabet: chi-squared over runs of the alphabet, as many as
    expect CELL characters each; number of runs of one kind of character; correlation of
    neighbours. Fisher's method joins the three p-values. Time is in proportion to the length, but for a sort.
    """
    ends = F.element_at(F.array(*[F.array(*map(F.lit, e)) for _, _, e in ENCODINGS]), code + 1)
    same = []  # chances that two neighbours, and three, are of one kind
    for power in (2, 3):
        shares = [sum(((b - a) / len(letters)) ** power for a, b in zip((0, *e), (*e, len(letters)))) for letters, _, e in ENCODINGS]
        same.append(F.element_at(F.array(*map(F.lit, shares)), code + 1))

    def tested(s: Column) -> Column:
        v, k = s["v"], s["k"]
        n = F.size(v)
        cells = F.greatest(F.lit(2), F.least(k, F.floor(n / CELL).cast("int")))

        def chi_squared(c: Column) -> Column:
            def term(j: Column) -> Column:
                share = (F.ceil((j + 1) * k / c["cells"]) - F.ceil(j * k / c["cells"])) / k
                return F.pow(F.get(c["upto"], j + 1) - F.get(c["upto"], j) - n * share, F.lit(2)) / (n * share)

            return F.aggregate(F.sequence(F.lit(0), c["cells"] - 1), F.lit(0.0), lambda a, j: a + term(j))

        def counted(c: Column) -> Column:
            upto = F.transform(F.sequence(F.lit(0), c["cells"]), lambda j: first_not_below(c["sorted"], j))
            return let(F.struct(c["cells"].alias("cells"), upto.alias("upto")), lambda d: F.struct(d["cells"].alias("cells"), chi_squared(d).alias("chi"), mean.alias("mean")))

        def kind(x: Column) -> Column:
            return (x >= s["ends"][0]).cast("int") + (x >= s["ends"][1]).cast("int")

        def stats(m: Column) -> Column:
            free = m["cells"] - 1
            cube = (F.pow(m["chi"] / free, F.lit(1 / 3)) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))
            later = F.slice(v, F.lit(2), n - 1)
            changes = total(F.transform(later, lambda x, i: (kind(x) != kind(F.get(v, i))).cast("int")))
            apart = 1 - s["two"]
            spread = F.sqrt((n - 1) * apart * (1 - apart) + 2 * (n - 2) * (s["three"] - s["two"] * s["two"]))
            square = F.aggregate(v, F.lit(0.0), lambda a, x: a + (x - m["mean"]) * (x - m["mean"]))
            product = F.aggregate(F.transform(later, lambda x, i: (x - m["mean"]) * (F.get(v, i) - m["mean"])), F.lit(0.0), lambda a, x: a + x)
            z_runs = F.abs(changes - (n - 1) * apart) / spread
            z_serial = F.when(square > 0, F.abs(product / square + 1 / n) * F.sqrt(n)).otherwise(40.0)  # one character: as far from random as the scale goes
            logs = [F.log(F.greatest(p, F.lit(1e-12))) for p in (upper_tail(cube), 2 * upper_tail(z_runs), 2 * upper_tail(z_serial))]
            return let(-(logs[0] + logs[1] + logs[2]), lambda x: x - F.log(1 + x + x * x / 2))

        mean = F.aggregate(v, F.lit(0.0), lambda a, x: a + x) / n
        dealt = F.struct(cells.alias("cells"), F.sort_array(F.transform(v, lambda x: F.floor(x * cells / k).cast("int"))).alias("sorted"))
        surprise = let(let(dealt, counted), stats)
        band = sum(((n >= b).cast("int") for b in BANDS[1:]), F.lit(0))
        return F.struct((s["code"] * len(BANDS) + band).alias("group"), F.least(F.lit(BINS), F.floor(F.greatest(surprise, F.lit(0.0)) * STEPS)).cast("int").alias("bin"))

    def values(s: Column) -> Column:
        places = F.transform(F.array_remove(F.split(s["plain"], ""), ""), lambda c: F.call_function("locate", c, s["alphabet"]) - 1)
        return let(F.struct(places.alias("v"), F.length(s["alphabet"]).alias("k"), *[s[c].alias(c) for c in ("code", "ends", "two", "three")]), tested)

    alphabet = F.element_at(F.array(*[F.lit(a) for a, _, _ in ENCODINGS]), code + 1)
    return let(F.struct(plain.alias("plain"), alphabet.alias("alphabet"), code.alias("code"), ends.alias("ends"), same[0].alias("two"), same[1].alias("three")), values)


def decoy(words: Column, token: Column, code: Column, nth: Column) -> Column:
    """An ordinary token as long as `token` (at most LONGEST) in encoding `code`: neighbouring words from a place that the token's hash sets, with numbers between."""
    size = F.least(F.length(token), F.lit(LONGEST))
    many = F.floor(size / 3).cast("int") + 1
    first = F.pmod(F.xxhash64(token, nth), F.size(words).cast("long")).cast("int")

    def made(s: Column) -> Column:
        part = F.transform(F.sequence(F.lit(0), s["many"] - 1), lambda i: F.get(words, F.pmod(s["first"] + i, F.size(words))))
        numbered = F.transform(part, lambda w, i: F.concat(F.initcap(w), F.when(i % 3 == 2, F.lpad(F.pmod(F.xxhash64(w, nth), F.lit(100)).cast("string"), 2, "0")).otherwise("")))
        return F.substring(F.array_join(numbered, ""), F.lit(1), s["size"])

    def in_alphabet(d: Column) -> Column:
        hexed = F.translate(F.lower(d), "ghijklmnopqrstuvwxyz", "0123456789abcdef0123")
        return F.when(code == HEX, hexed).when(code == BASE32, F.translate(F.upper(d), "0189", "2345")).when(code == BASE36, F.lower(d)).otherwise(d)

    return let(let(F.struct(size.alias("size"), many.alias("many"), first.alias("first")), made), in_alphabet)


def scan(docs: DataFrame, rate: float = 0.05, whole: str | None = None) -> DataFrame:
    """(doc_id, spans): all spans of each whole text, struct<start, rank, end, kind, begin, stop> by start, then kind.

    With whole, a column of that name has all columns of docs too: it is written beside the spans, so that nothing is joined back.

    Base kinds assign, access and hex are pattern matches. Kind random is added for tokens of 20 or more
    characters that touch no base span, are written in a known encoding, and look more random than ordinary tokens do.
    For each token DECOYS ordinary tokens of its length and encoding are made of the words of its own text; the share of a
    group's decoys (a group is an encoding and a band of lengths: tests see more in longer tokens) that do as well as a token is its p-value under the
    hypothesis that it is ordinary. The Benjamini-Hochberg rule over all tokens of a group in the table then holds the share of
    ordinary tokens among those reported to about `rate`. It needs the counts of both in bins, at most 3,216 rows.
    Null and empty texts have no spans; repeated rows are scanned each for itself; time is in proportion to a text's length and spans.
    """
    text = F.coalesce(F.col("text"), F.lit(""))

    def base(i: int, kind: str, pattern: str, least: int, group: int) -> Column:
        kept = F.filter(matches(text, pattern, group), lambda m: m["size"] >= least)
        return F.transform(kept, lambda m: F.struct(m["start"].alias("start"), F.lit(i).alias("rank"), m["end"].alias("end"), F.lit(kind).alias("kind"), m["begin"].alias("begin"), m["stop"].alias("stop")))

    names = [k[0] for k in KINDS]
    carried = [F.struct("*").alias(whole)] if whole else []
    kept = ["doc_id", whole] if whole else ["doc_id"]
    found = docs.select("doc_id", *carried, *[base(i, *k).alias(k[0]) for i, k in enumerate(KINDS)], matches(text, RANDOM).alias("tokens"), text.alias("body"))

    def apart(edges: Column) -> Column:
        def touches(t: Column, kind: str) -> Column:
            # a kind's spans don't overlap, so the last one that starts before the token's end is the one to ask
            return let(first_not_below(edges[f"{kind}_starts"], t["end"]), lambda i: (i > 0) & F.coalesce(F.get(edges[f"{kind}_ends"], i - 1) > t["start"], F.lit(False)))

        return F.filter("tokens", lambda t: ~(touches(t, names[0]) | touches(t, names[1]) | touches(t, names[2])))

    edges = F.struct(*[F.col(k)[c].alias(f"{k}_{c}s") for k in names for c in ("start", "end")])
    known = F.transform(F.when(F.size("tokens") > 0, let(edges, apart)).otherwise(F.col("tokens")), lambda t: F.struct(*[t[c].alias(c) for c in ("start", "end", "begin", "stop", "found")], encoding_of(t["found"]).alias("code")))
    found = found.select(*kept, F.array_sort(F.concat(*names)).alias("base"), "body", F.filter(known, lambda t: t["code"].isNotNull()).alias("tokens"))
    words = F.when(F.size("tokens") > 0, F.regexp_extract_all("body", F.lit(r"\b[A-Za-z]{3,19}\b"), F.lit(0)))
    found = found.select(*kept, "base", "tokens", F.when(F.size(words) > 0, words).otherwise(F.array(*map(F.lit, PLAIN_WORDS))).alias("words"))
    tried = F.transform("tokens", lambda t: F.struct(*[t[c].alias(c) for c in ("start", "end", "begin", "stop")], battery(spelt(t["found"], t["code"]), t["code"]).alias("test")))
    plain = F.flatten(F.transform("tokens", lambda t: F.transform(F.sequence(F.lit(1), F.lit(DECOYS)), lambda n: battery(decoy(F.col("words"), t["found"], t["code"], n), t["code"]))))
    found = table(found.select(*kept, "base", tried.alias("tried"), plain.alias("decoys")), "secrets")
    seen = found.select(F.explode(F.concat(F.transform("tried.test", lambda t: F.struct(t.alias("t"), F.lit(1).alias("own"))), F.transform("decoys", lambda t: F.struct(t.alias("t"), F.lit(0).alias("own"))))).alias("x"))
    bins = seen.groupBy("x.t.group", "x.t.bin").agg(F.sum("x.own").alias("n"), F.sum(1 - F.col("x.own")).alias("d"))
    reach, all_of = W.partitionBy("group").orderBy("bin"), W.partitionBy("group")
    steps = bins.select("group", "bin", *[F.sum(c).over(w).alias(f"{c}_{a}") for c in ("n", "d") for w, a in ((reach, "up"), (all_of, "all"))])
    below = (1 + F.col("d_up")) / (1 + F.col("d_all")) <= rate * F.col("n_up") / F.col("n_all")
    cuts = {r.group: r.cut for r in steps.where(below).groupBy("group").agg(F.max("bin").alias("cut")).collect()}
    limits = F.array(*[F.lit(cuts.get(g, -1)) for g in range(len(ENCODINGS) * len(BANDS))])
    random = F.filter("tried", lambda t: t["test"]["bin"] <= F.element_at(limits, t["test"]["group"] + 1))
    added = F.transform(random, lambda t: F.struct(t["start"].alias("start"), F.lit(len(KINDS)).alias("rank"), t["end"].alias("end"), F.lit("random").alias("kind"), t["begin"].alias("begin"), t["stop"].alias("stop")))
    return found.select(*kept, F.array_sort(F.concat("base", added)).alias("spans"))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secrets_digest(docs: DataFrame) -> DataFrame:
    spans = scan(docs)

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["rank"] < len(KINDS))
    return spans.select("doc_id", *[count(k[0]) for k in KINDS], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def redacted(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """docs with every span (overlapping ones as one) of text replaced by mark, and n_chars, where there is one, to match; all rows and columns stay."""
    whole = free_name(docs, "whole")
    found = scan(docs, whole=whole)
    body = F.col(whole)["text"]
    plain = body.cast("binary")  # its parts are taken by place, without a walk from its start

    def masked(s: Column) -> Column:
        def piece(x: Column, i: Column) -> Column:
            before = F.get(s["before"], i)
            between = F.substring(s["plain"], before + 1, x["begin"] - before).cast("string")
            return F.when(x["begin"] >= before, F.concat(between, F.lit(mark))).otherwise("")

        rest = F.substring(s["plain"], F.array_max(s["spans"]["stop"]) + 1, F.octet_length(s["plain"])).cast("string")
        return F.concat(F.array_join(F.transform(s["spans"], piece), ""), rest)

    clean = F.size("spans") == 0
    text = F.when(clean, body).otherwise(let(F.struct(F.col("spans"), most_before(F.col("spans")["stop"]).alias("before"), plain.alias("plain")), masked))
    made = found.select(whole, "spans", text.alias("masked"))
    changed = {"text": F.col("masked"), "n_chars": F.when(clean, F.col(whole)["n_chars"]).otherwise(F.length("masked")).cast("long")} if "n_chars" in docs.columns else {"text": F.col("masked")}
    return made.select(*[changed.get(c, F.col(whole)[c]).alias(c) for c in docs.columns])
