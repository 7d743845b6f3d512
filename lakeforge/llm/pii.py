"""Personal data by weak supervision, in DataFrame functions only.

Fixed patterns give the base spans, which always stay. Weaker patterns propose more. Five labelers vote (+1, 0, -1)
on every proposed span: format (regex), gazetteer (the lists of ``gazetteers.json``), context words before it, checksum, and
clean edges. Votes are counted by pattern (at most 2 x kinds x 3^5 rows, whatever the input); expectation-maximisation
over those counts, in which base spans are known to be right, estimates how far each labeler can be trusted, and a logistic
span classifier trained on its posteriors becomes one SQL expression. Proposals it accepts that overlap no base span are added.

Places are code points from 0, ends exclusive. Null texts count as empty. Patterns have no nested
loops that recurse or scan quadratically, so long runs of digits or letters are safe; n matches in a text are worked on in
blocks of about sqrt(n), each with its own stretch of the text. Extra columns are kept, whatever their names. Repeated rows are
treated alike. Empty tables give empty results.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass
from functools import partial
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeforge.llm.common import staged

KINDS = ("email", "ip", "card", "phone", "ssn", "iban", "street")
VOTES = ("format", "gazetteer", "context", "checksum", "edges")

# Base patterns. They find what the plain patterns find, leftmost and whole, but start only where a
# run starts (or the last match ended) and repeat possessively.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}(?![ -]?[0-9])"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
#: Lists of top-level domains, mail providers, calling codes, card prefixes, IBAN lengths and street words.
LISTS = json.loads(Path(__file__).with_name("gazetteers.json").read_text(encoding="utf-8"))


def any_of(*names: str) -> str:
    """Street words of the lists ``names`` as an alternation."""
    return "(?:" + "|".join(w.replace(".", r"\.") for n in names for w in LISTS["street_words"][n]) + ")"


NAME = r"\p{Lu}[\p{L}'’.-]{1,30}"
# Weaker proposals.
WEAK = (
    (0, r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++(?: ?(?:\(at\)|\[at\]|\{at\}) ?[A-Za-z0-9-]++(?: ?(?:\.|\(dot\)|\[dot\]|\{dot\}) ?[A-Za-z0-9-]++)++| at [A-Za-z0-9-]++(?: dot [A-Za-z0-9-]++)++)", r"at[)\]}]| dot "),
    (1, r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Fa-f:])", "[0-9A-Fa-f]:[0-9A-Fa-f]"),
    (2, r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}(?![ -]?[0-9])", "[0-9]"),
    (3, r"(?<![0-9A-Za-z+.-])(?<![0-9] )(?:(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}|0[1-9](?:[ .][0-9]{2}){4}|00[1-9][0-9]{0,2}(?:[ -][0-9]{2,4}){3,4})(?![0-9]|[ .-][0-9])", "[0-9]"),
    (4, r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "[0-9]-[0-9]"),
    (5, r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])", "[0-9]"),
    (6, rf"(?<![0-9\p{{L}}.,-])(?:[0-9]{{1,5}}[A-Za-z]? (?:{NAME} ){{1,3}}{any_of('after_name', 'after_name_weak')}|[0-9]{{1,4}},? {any_of('before_name', 'before_name_weak')}(?: (?:de|du|des|la|le|del|los|las)){{0,2}} {NAME}(?: {NAME}){{0,2}})(?!\p{{L}})|(?<!\p{{L}})(?:\p{{Lu}}\p{{Ll}}{{2,30}}{any_of('suffix', 'suffix_weak')} [0-9]{{1,4}}[a-z]?|(?i:{any_of('before_name', 'before_name_weak')})(?: (?:de|del|la|los|las)){{0,2}}(?: {NAME}){{1,3}},? [0-9]{{1,4}})(?![0-9\p{{L}}])", "[0-9]"),
)
# Words that announce a value, by kind, and words that announce some other number.
CONTEXT = (r"(e-?mail|mail|contact|write|reach|correo|courriel|kontakt)", r"\b(ip|host|server|address|addr|login|adresse)\b", r"(card|visa|mastercard|amex|credit|debit|payment|karte|carte|tarjeta)", r"(phone|tel|call|mobile|cell|fax|telefon|whatsapp|sms|numero)", r"(ssn|social security|soc\. sec|tax id)", r"(iban|account|bank|konto|compte|cuenta|transfer|überweis|virement)", r"(address|live[sd]? (at|in|on)|home|resid|wohn|adresse|anschrift|habite|domicil|direcci|vive en)")
OTHER = r"\b(order|invoice|isbn|issn|serial|version|model|part|sku|tracking|ticket|build|bestellung|rechnung|commande|facture|pedido|factura)( (no\.?|number|nr\.?|id))?[ :#]*$"
#: Code points before a span that are read for context.
BEFORE = 32


def digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(d: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""
    r = F.reverse(d)

    def add(total, i):
        x = F.substring(r, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + x - F.when(x > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(d), F.lit(1))), F.lit(0), add) % 10 == 0


def remainder_97(value: Column) -> Column:
    """What remains of an account number by the IBAN rule: its first four signs last, letters as 10 to 35; 1 if it is right."""
    v = F.regexp_replace(value, " ", "")
    turned = F.concat(F.substring(v, F.lit(5), F.length(v)), F.substring(v, 1, 4))

    def add(rest, i):
        c = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(c <= 57, rest * 10 + c - 48).otherwise(rest * 100 + c - 55) % 97

    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(turned), F.lit(1))), F.lit(0), add)


def listed(kind: int, value: Column) -> Column:
    """The gazetteer's vote: 1 if the value's beginning or end is on the lists of its kind, -1 if not, 0 if it can't tell."""
    d, words = digits(value), LISTS["street_words"]
    prefix = lambda n: F.substring(d, 1, n)
    yes_no = lambda good: F.when(good, 1).otherwise(-1)
    if kind == 0:
        labels = F.split(F.regexp_replace(F.lower(value), r"^.*(@|[(\[{]at[)\]}]| at )| ?[(\[{]?\bdot\b[)\]}]? ?| ", "."), r"\.+")
        return F.when(F.exists(labels, lambda x: x.isin(LISTS["providers"])), 1).otherwise(yes_no(F.element_at(labels, -1).isin(LISTS["tlds"])))
    if kind == 1:
        return yes_no(F.when(F.contains(value, F.lit(":")), F.lower(value).rlike("^([23][0-9a-f]{3}|f[cd][0-9a-f]{2}|fe[89ab][0-9a-f]):")).otherwise(value.rlike("^0*([1-9]|[1-9][0-9]|1[0-9]{2}|2[01][0-9]|22[0-3])[.]")))
    if kind == 2:
        ranges = [prefix(len(low)).between(low, high) for low, high in LISTS["card_prefixes"]]
        return yes_no(F.exists(F.array(*ranges), lambda x: x))
    if kind == 3:
        code = F.when(value.rlike("^00"), F.substring(d, 3, 3)).otherwise(prefix(3))
        known = F.exists(F.array(*(F.substring(code, 1, n) for n in (1, 2, 3))), lambda x: x.isin(LISTS["calling_codes"]))
        return yes_no(F.when(value.rlike(r"^(\+|00)"), known).when(value.rlike("^0"), F.length(d) == 10).otherwise(d.rlike("^[2-9][0-9]{2}[2-9]")))
    if kind == 4:
        return yes_no(value.rlike("^(?!000|666|9)[0-9]{3}-(?!00)"))
    if kind == 5:
        v = F.regexp_replace(value, " ", "")
        return yes_no(F.concat(F.substring(v, 1, 2), F.length(v).cast("string")).isin(LISTS["iban_lengths"]))
    strong = [w.lower() for n in ("after_name", "before_name") for w in words[n]]
    tokens = F.split(F.lower(value), "[ ,]+")
    return F.when(F.exists(tokens, lambda x: x.isin(strong) | x.rlike(any_of("suffix") + "$")), 1).otherwise(0)


def octets(x: Column) -> Column:
    """Whether all four parts are at most 255, whatever zeros lead."""
    return x.rlike(r"^(0*(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(\.|$)){4}$")


def let(value: Column, fn) -> Column:
    """``fn`` of a value that is computed once, however often ``fn`` uses it."""
    return F.transform(F.array(value), fn)[0]


def blocks(items: Column) -> Column:
    """An array cut into arrays of about the square root of its size."""
    def cut(x):
        n = F.size(x["items"])
        return F.transform(F.filter(F.sequence(F.lit(0), n, x["size"]), lambda i: i < n), lambda i: F.slice(x["items"], i + 1, x["size"]))

    sized = lambda a: F.struct(a.alias("items"), F.greatest(F.ceil(F.sqrt(F.size(a))).cast("int"), F.lit(1)).alias("size"))
    return let(items, lambda a: let(sized(a), cut))


def running(sums: Column) -> Column:
    """For each item of an integer array the sum of those before it."""
    none = F.expr("cast(array() as array<int>)")
    return F.aggregate(sums, F.struct(F.lit(0).alias("at"), none.alias("out")), lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])


def matches(text: Column, pattern: str, sign: str = "") -> Column:
    """Array of (start, end, value, before: the text before it, sides: the characters around it) of all matches.

    Texts in which ``sign``, a short pattern that is part of each match, does not occur are not searched.
    """
    values, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    empty = F.expr("cast(array() as array<struct<start:int,end:int,value:string,before:string,sides:string>>)")
    pairs = F.filter(F.zip_with(between, values, lambda b, v: F.struct(F.length(b).alias("gap"), F.length(v).alias("n"), v.alias("value"))), lambda p: p["value"].isNotNull())
    parts = F.transform(blocks(pairs), lambda b: F.struct(b.alias("pairs"), F.aggregate(b, F.lit(0), lambda acc, p: acc + p["gap"] + p["n"]).alias("n")))
    # of each block: where it starts, and its text with what comes just before and after
    placed = let(parts, lambda ps: F.zip_with(ps, running(F.transform(ps, lambda x: x["n"])), lambda x, at: F.struct(x["pairs"].alias("pairs"), at.alias("at"), F.substring(text, F.greatest(at - BEFORE, F.lit(0)) + 1, x["n"] + BEFORE + 1).alias("piece"))))

    def found(x):
        def step(acc, p):
            start = acc["at"] + p["gap"]
            end = start + p["n"]
            origin = F.greatest(x["at"] - BEFORE, F.lit(0))
            before = F.substring(x["piece"], F.greatest(start - BEFORE, F.lit(0)) - origin + 1, F.least(start, F.lit(BEFORE)))
            sides = F.concat(F.when(start > 0, F.substring(x["piece"], start - origin, F.lit(1))).otherwise(" "), F.substring(x["piece"], end - origin + 1, F.lit(1)))
            one = F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"), p["value"].alias("value"), before.alias("before"), sides.alias("sides"))
            return F.struct(end.cast("int").alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

        return F.aggregate(x["pairs"], F.struct(x["at"].alias("at"), empty.alias("out")), step, lambda acc: acc["out"])

    return F.when(text.rlike(sign) & text.rlike(pattern) if sign else text.rlike(pattern), F.flatten(F.transform(placed, found))).otherwise(empty)


def votes(kind: int, base: bool, m: Column) -> Column:
    """One proposal as (kind, start, end, base, the five votes)."""
    value, d, before, sides = m["value"], digits(m["value"]), F.lower(m["before"]), m["sides"]
    sign = lambda good, bad=None: F.when(good, 1).otherwise(F.lit(-1) if bad is None else F.when(bad, -1).otherwise(0)).cast("int")
    check = {0: F.lit(0), 1: sign(octets(value)) if base else F.lit(0), 2: sign(luhn(d)), 3: sign(F.length(d).between(8, 15)) if base else F.lit(0), 4: sign(value.rlike(r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)")), 5: sign(remainder_97(value) == 1), 6: F.lit(0)}[kind]
    shape = {2: sign(F.length(d) >= 15, F.length(d) < 13), 3: sign(value.rlike(r"[-.()]|^00|^0[1-9]( [0-9]{2}){4}$")), 5: sign(value.rlike(r"^[A-Z0-9]+$|^[A-Z0-9]{4}( [A-Z0-9]{4})+( [A-Z0-9]{1,3})?$")), 6: sign(value.rlike(r"^([0-9]+[A-Za-z]?,? )?\p{L}[\p{L}'’.-]+ "))}
    form = F.lit(1) if base else shape.get(kind, sign(value.rlike(r"[-.()@:\[{]"), F.lit(False)))
    clue = F.when(before.rlike(OTHER), -1).otherwise(sign(before.rlike(CONTEXT[kind]), F.lit(False)))
    return F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), F.lit(base).alias("base"), form.cast("int").alias("format"), listed(kind, value).cast("int").alias("gazetteer"), clue.cast("int").alias("context"), check.cast("int").alias("checksum"), sign(sides.rlike(r"^[\s(\[<:,;|\"']([\s)\]>.,;:|!?\"']|$)"), sides.rlike(r"[0-9A-Za-z]")).alias("edges"))


def proposals(text: Column) -> tuple[Column, Column]:
    """Base spans by kind and start, then the weaker proposals that overlap none of them."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    good = (
        (0, EMAIL, "@", lambda m: F.lit(True)),
        (1, IP, r"[0-9]\.[0-9]", lambda m: octets(m["value"])),
        (2, CARD, "[0-9]", lambda m: luhn(digits(m["value"]))),
        (3, PHONE, r"\+[0-9]", lambda m: F.length(digits(m["value"])).between(8, 15)),
    )
    base = F.concat(*(F.transform(F.filter(matches(text, p, s), ok), partial(votes, k, True)) for k, p, s, ok in good))
    weak = F.concat(*(F.transform(matches(text, p, s), partial(votes, k, False)) for k, p, s in WEAK))
    return base, weak


def clear_of(weak: Column, base: Column) -> Column:
    """The spans of ``weak`` that overlap none of ``base``, which is searched block by block in the order of starts."""
    ordered = blocks(F.array_sort(F.transform(base, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))))
    bounds = F.transform(ordered, lambda b: F.struct(b.alias("spans"), F.array_max(F.transform(b, lambda s: s["end"])).alias("end"), b[0]["start"].alias("start")))
    meets = lambda b, w: (b["start"] < w["end"]) & (w["start"] < b["end"])
    return let(bounds, lambda all_: F.filter(weak, lambda w: ~F.exists(all_, lambda b: meets(b, w) & F.exists(b["spans"], lambda s: meets(s, w)))))


def with_proposals(rows: DataFrame) -> DataFrame:
    """``row``, ``pii_base`` and ``pii_weak`` of rows ``row, text``."""
    base, weak = proposals(F.col("text"))
    some = rows.select("row", base.alias("pii_base"), weak.alias("pii_weak"))
    some_of_both = (F.size("pii_weak") > 0) & (F.size("pii_base") > 0)
    return some.withColumn("pii_weak", F.when(some_of_both, clear_of(F.col("pii_weak"), F.col("pii_base"))).otherwise(F.col("pii_weak")))


@dataclass
class Classifier:
    """Logistic weights: ``bias`` by kind, ``weight[labeler, vote]``; ``trust[labeler]`` is what EM found."""

    bias: list[float]
    weight: dict[tuple[str, int], float]
    trust: dict[str, float]

    def accepts(self, span: Column) -> Column:
        score = F.element_at(F.array(*map(F.lit, self.bias)), span["kind"] + 1)
        for (name, vote), w in self.weight.items():
            score = score + F.when(span[name] == vote, w).otherwise(0.0)
        return score > 0


def estimate(patterns: list[tuple[int, bool, tuple[int, ...], int]], rounds: int = 40) -> tuple[list[float], dict[str, float]]:
    """EM for a two-class model in which labelers vote independently; returns a posterior for each pattern.

    Base spans are right; what share of the others is, is estimated by kind.
    """
    post = [1.0 if base else min(0.9, max(0.1, 0.5 + 0.2 * sum(v))) for _, base, v, _ in patterns]
    table: list[dict] = []
    for _ in range(rounds):
        table = []
        for i in range(len(VOTES)):
            t = {}
            for y in (0, 1):
                n = {x: 1.0 + (2.0 if x == (1 if y else -1) else 0.0) for x in (-1, 0, 1)}
                for (_, _, v, c), p in zip(patterns, post, strict=True):
                    n[v[i]] += c * (p if y else 1 - p)
                t[y] = {x: n[x] / sum(n.values()) for x in n}
            table.append(t)
        prior = {}
        for kind in range(len(KINDS)):
            rows = [(c, p) for (k, base, _, c), p in zip(patterns, post, strict=True) if k == kind and not base]
            prior[kind] = (1.0 + sum(c * p for c, p in rows)) / (2.0 + sum(c for c, _ in rows))
        for j, (kind, base, v, _) in enumerate(patterns):
            z = math.log(prior[kind] / (1 - prior[kind])) + sum(math.log(table[i][1][x] / table[i][0][x]) for i, x in enumerate(v))
            post[j] = 1.0 if base else 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))
    return post, {name: table[i][1][1] / (table[i][1][1] + table[i][0][1]) for i, name in enumerate(VOTES)}


def train(spans: DataFrame) -> Classifier:
    """``spans`` has ``kind``, ``base``, the votes and nothing that grows: only counts of vote patterns reach the driver.

    Base spans teach the weights but have a bias of their own, so that they do not raise those of proposals.
    """
    rows = spans.groupBy("kind", "base", *VOTES).agg(F.count("*").alias("n")).collect()
    patterns = sorted((r.kind, r.base, tuple(r[v] for v in VOTES), r.n) for r in rows)
    post, trust = estimate(patterns) if patterns else ([], {})
    bias, known, weight = [-0.5] * len(KINDS), 0.0, {(name, vote): 0.6 * vote for name in VOTES for vote in (-1, 1)}
    totals = {base: sum(n for _, b, _, n in patterns if b == base) or 1 for base in (False, True)}
    for _ in range(400):
        gb, gk, gw = [0.01 * (b + 0.5) for b in bias], 0.0, {k: 0.01 * w for k, w in weight.items()}
        for (kind, base, v, n), p in zip(patterns, post, strict=True):
            z = bias[kind] + known * base + sum(weight.get((VOTES[i], x), 0.0) for i, x in enumerate(v))
            g = (1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - p) * n / totals[base]
            gk, gb[kind] = gk + g * base, gb[kind] + g * (not base)
            for i, x in enumerate(v):
                if x:
                    gw[VOTES[i], x] += g
        bias, known, weight = [b - 0.5 * g for b, g in zip(bias, gb, strict=True)], known - 0.5 * gk, {k: w - 0.5 * gw[k] for k, w in weight.items()}
    return Classifier(bias, weight, trust)


def found_in(docs: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """``row`` (a struct of the columns ``keep``), ``base`` and ``spans``: arrays of (kind number, start, end), sorted."""
    found = staged(with_proposals(docs.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row"), F.col("text").cast("string").alias("text"))))
    spans = found.where("size(pii_base) + size(pii_weak) > 0").select(F.inline(F.concat("pii_base", "pii_weak")))
    model = train(spans)
    short = lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    base = F.transform("pii_base", short)
    added = F.transform(F.filter("pii_weak", model.accepts), short)
    return found.select("row", base.alias("base"), F.array_sort(F.concat(base, F.when(F.size("pii_weak") > 0, added).otherwise(F.slice(base, 1, 0)))).alias("spans"))


def find(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` with ``base`` and ``spans``, which replace columns of these names."""
    return found_in(docs, keep).select(*(f"row.`{c}`" for c in keep if c not in ("base", "spans")), "base", "spans")


def written(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))))


def digest(found: DataFrame) -> DataFrame:
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return found.select("doc_id", *(count(k) for k in range(4)), F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` with every found span replaced by its kind in brackets; of overlapping ones the first."""
    found = found_in(docs, tuple(docs.columns))
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    by_start = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    none = F.expr("cast(array() as array<int>)")
    # each block of spans with the end of all before it, and its own stretch of the text
    ends = lambda bs: F.aggregate(bs, F.struct(F.lit(0).alias("at"), none.alias("out")), lambda acc, b: F.struct(F.greatest(acc["at"], F.array_max(F.transform(b, lambda s: s["end"]))).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: F.concat(acc["out"], F.array(acc["at"])))
    with_ends = let(blocks(by_start), lambda bs: F.struct(bs.alias("bs"), ends(bs).alias("ends")))
    piece = lambda b, at: F.substring(text, at + 1, F.greatest(F.array_max(F.transform(b, lambda s: s["end"])) - at, F.lit(0)))
    cut = let(with_ends, lambda x: F.struct(F.zip_with(x["bs"], F.slice(x["ends"], F.lit(1), F.size(x["bs"])), lambda b, at: F.struct(b.alias("spans"), at.alias("from"), piece(b, at).alias("piece"))).alias("blocks"), F.element_at(x["ends"], -1).alias("end")))

    def masked(b):
        def step(acc, s):
            label = F.concat(F.lit("["), F.upper(F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)), F.lit("]"))
            grown = F.concat(acc["out"], F.substring(b["piece"], acc["at"] - b["from"] + 1, s["start"] - acc["at"]), label)
            inside = s["start"] < acc["at"]
            return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(inside, acc["out"]).otherwise(grown).alias("out"))

        return F.aggregate(b["spans"], F.struct(b["from"].alias("at"), F.lit("").alias("out")), step, lambda acc: acc["out"])

    whole = let(cut, lambda x: F.concat(F.array_join(F.transform(x["blocks"], masked), ""), F.substring(text, x["end"] + 1, F.length(text))))
    kind = found.schema["row"].dataType["text"].dataType
    redacted = F.when(F.size("spans") > 0, whole).otherwise(F.col("row.text").cast("string")).cast(kind)
    return found.select(*(redacted.alias("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns))
