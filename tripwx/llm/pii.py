"""Personal data: proposed by patterns, confirmed by checksums, scored by context.

All work is Column expressions: a pattern's matches and the gaps between
them come from one ``regexp_extract_all`` and one ``split`` (possessive,
without backtracking over long runs), and running lengths turn them into
code-point spans.  Only texts that can hold a match of a kind are searched
for it.

Kinds email, ip, card and phone are the base ones: every match that passes
its validator (parts up to 255, Luhn on 13 to 19 digits, 9 to 15 digits)
is a span, whatever its score.  The added kinds need a confirmed checksum
or a context word: iban (mod-97) and ssn (context).

Defined results: a null text is searched as an empty one; repeated rows
give repeated results; a match that fails its validator is dropped and not
retried from a later start; an empty table gives no rows; other columns
pass through ``find`` untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTEXT_CHARS = 48


@dataclass(frozen=True)
class Kind:
    """``pattern`` proposes, ``can`` is a cheap condition that any text with
    a match meets, ``confirm`` is 'email', 'ip', 'luhn', 'digits', 'mod97'
    or 'area'; ``start`` is the score of a confirmed match, ``context`` adds
    ``lift`` when one of its words stands within CONTEXT_CHARS before it."""

    name: str
    pattern: str
    can: str
    confirm: str
    start: float
    context: str
    lift: float = 0.3
    base: bool = True


_LABEL = "[A-Za-z0-9-]++"
KINDS = (
    Kind("email", rf"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@{_LABEL}(?:\.{_LABEL})++", "@", "email", 0.7,
         "mail|contact|write|reach"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]++\.[0-9]", "ip", 0.6,
         "ip|address|host|server"),
    Kind("card", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){12,18}+(?![\x20-]?[0-9])",
         r"[0-9](?:[\x20-]?+[0-9]){12}", "luhn", 0.7, "card|credit|debit|visa|pay"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", "digits", 0.6, "phone|call|tel|mobile|fax"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
         r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}", "mod97", 0.6, "iban|account|bank|transfer", base=False),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", "area", 0.3,
         "ssn|social|security", base=False),
)
THRESHOLD = 0.5
CHUNK = 64


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(c: Column) -> Column:
    """Luhn on the digits of ``c``."""
    def add(acc, d):
        twice = d * 2
        return F.struct(
            (acc["s"] + F.when(acc["even"], F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)).alias("s"),
            (~acc["even"]).alias("even"))
    ds = F.transform(F.filter(F.split(F.reverse(digits(c)), ""), lambda x: x != ""), lambda x: x.cast("int"))
    start = F.struct(F.lit(0).alias("s"), F.lit(False).alias("even"))
    return F.aggregate(ds, start, add, lambda a: a["s"] % 10 == 0)


def mod97(c: Column) -> Column:
    """The rearranged letters-as-numbers value of an account number is 1 mod 97."""
    plain = F.replace(c, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))

    def add(acc, ch):
        code = F.ascii(ch)
        return F.when(code >= 65, (acc * 100 + code - 55) % 97).otherwise((acc * 10 + code - 48) % 97)
    signs = F.filter(F.split(turned, ""), lambda x: x != "")
    return F.aggregate(signs, F.lit(0), add) == 1


def confirmed(rule: str, m: Column) -> Column:
    if rule == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
        return m.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if rule == "luhn":
        return luhn(m)
    if rule == "digits":
        return F.length(digits(m)).between(9, 15)
    if rule == "mod97":
        return mod97(m)
    if rule == "area":
        return ~m.rlike("^(?:000|666|9[0-9]{2})|-00-|-0000$")
    return F.lit(True)


def _possible(kind: Kind, text: Column) -> Column:
    return text.contains("@") if kind.name == "email" else text.rlike(kind.can)


def _pieces(kind: Kind, text: Column) -> Column:
    """The matches of a kind and the gaps around them; null if there can be none."""
    return F.when(_possible(kind, text), F.struct(
        F.split(text, kind.pattern, -1).alias("gaps"),
        F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)).alias("found")))


def _bound(value: Column, body) -> Column:
    """``body(value)``, with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


def _running(sizes: Column, begin: Column) -> Column:
    """The sum of ``begin`` and all sizes before each."""
    start = F.struct(begin.alias("at"), F.expr("cast(array() as array<int>)").alias("all"))
    return F.aggregate(sizes, start, lambda acc, n: F.struct(
        (acc["at"] + n).alias("at"), F.concat(acc["all"], F.array(acc["at"])).alias("all")), lambda acc: acc["all"])


def _offsets(sizes: Column) -> Column:
    """As ``_running`` from 0 on.  An array cannot grow in place, so the sums
    are taken inside chunks of ``CHUNK``, from the sums over the chunks before."""
    def chunked(all_):
        many = F.greatest(F.ceil(F.size(all_) / F.lit(CHUNK)).cast("int") - 1, F.lit(0))
        chunks = F.transform(F.sequence(F.lit(0), many), lambda c: F.slice(all_, c * CHUNK + 1, F.lit(CHUNK)))
        return _bound(chunks, lambda cs: F.flatten(F.zip_with(
            cs, _running(F.transform(cs, lambda c: F.aggregate(c, F.lit(0), lambda a, n: a + n)), F.lit(0)), _running)))
    return _bound(sizes, chunked)


def _spans(kind: Kind, pieces: Column) -> Column:
    """array<struct<kind,start,end,score,match,keep>> of every match."""
    gaps = F.slice(pieces["gaps"], 1, F.size(pieces["found"]))
    before = F.slice(F.concat(F.array(F.lit("")), pieces["found"]), 1, F.size(pieces["found"]))
    sizes = F.zip_with(gaps, pieces["found"], lambda g, m: F.length(g) + F.length(m))
    pairs = F.zip_with(gaps, pieces["found"], lambda g, m: F.struct(g.alias("g"), m.alias("m")))
    near = F.zip_with(before, gaps, lambda b, g: F.right(F.concat(F.right(b, F.lit(CONTEXT_CHARS)), g), F.lit(CONTEXT_CHARS)))

    def place(pair, at):
        begin = at + F.length(pair["g"])
        return F.struct(begin.alias("start"), (begin + F.length(pair["m"])).alias("end"), pair["m"].alias("match"))
    placed = F.zip_with(pairs, _offsets(sizes), place)
    found = F.zip_with(placed, near, lambda x, n: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), n.alias("near"), x["match"].alias("match")))

    def judge(x):
        score = F.lit(kind.start) + F.when(F.lower(x["near"]).rlike(kind.context), kind.lift).otherwise(0.0)
        sure = F.lit(True) if kind.base else score >= THRESHOLD
        return F.struct(F.lit(kind.name).alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
                        score.alias("score"), x["match"].alias("match"),
                        (confirmed(kind.confirm, x["match"]) & sure).alias("keep"))
    return F.transform(found, judge)


def _prefix(taken: list[str]) -> str:
    """A prefix that no column of the table starts with."""
    p = "_pii_"
    while any(c.lower().startswith(p) for c in taken):
        p = "_" + p
    return p


def find(docs: DataFrame, kinds: tuple[Kind, ...] = KINDS, text: str = "text", out: str = "pii") -> DataFrame:
    """``docs`` with ``out``: array<struct<kind,start,end,score,match>> of
    the kept spans (code points, end exclusive), by kind as listed, then start."""
    p = _prefix(docs.columns)
    body = F.coalesce(F.col(text), F.lit(""))
    df = docs.withColumns({f"{p}{k.name}": _pieces(k, body) for k in kinds})
    empty = F.expr("cast(array() as array<struct<kind:string,start:int,end:int,score:double,match:string>>)")
    lists = []
    for k in kinds:
        kept = F.filter(_spans(k, F.col(f"{p}{k.name}")), lambda x: x["keep"])
        lists.append(F.coalesce(F.transform(kept, lambda x: F.struct(
            x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
            x["score"].alias("score"), x["match"].alias("match"))), empty))
    return df.withColumn(out, F.concat(*lists)).drop(*[f"{p}{k.name}" for k in kinds])


def _replaced(gaps: Column, spans: Column, mark: str) -> Column:
    shown = F.zip_with(F.slice(gaps, 1, F.size(spans)), spans,
                       lambda g, x: F.concat(g, F.when(x["keep"], mark).otherwise(x["match"])))
    return F.concat(F.array_join(shown, ""), F.element_at(gaps, -1))


def redact(docs: DataFrame, kinds: tuple[Kind, ...] = KINDS, text: str = "text") -> DataFrame:
    """``docs`` with every kept span replaced by ``[KIND]``.  Kinds are
    redacted in listed order, each on the text that the earlier ones left;
    texts without a span stay as they are, a null stays null."""
    p = _prefix(docs.columns)
    df = docs
    for k in kinds:
        df = df.withColumn(f"{p}p", _pieces(k, F.col(text)))
        df = df.withColumn(f"{p}s", _spans(k, F.col(f"{p}p")))
        gone = _replaced(F.col(f"{p}p")["gaps"], F.col(f"{p}s"), f"[{k.name.upper()}]")
        df = df.withColumn(text, F.when(F.size(F.col(f"{p}s")) > 0, gone).otherwise(F.col(text)))
        df = df.drop(f"{p}p", f"{p}s")
    return df.select(*docs.columns)


def digest(found: DataFrame, spans: str = "pii") -> DataFrame:
    """Counts per base kind, the digest of the base spans and all spans as text."""
    def text(items):
        return F.array_join(F.transform(items, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    base = [k.name for k in KINDS if k.base]

    def of(name):
        return F.filter(F.col(spans), lambda x: x["kind"] == name)
    only = F.filter(F.col(spans), lambda x: x["kind"].isin(base))
    return found.select(
        "doc_id", *[F.size(of(n)).cast("long").alias(f"n_{n}") for n in base],
        F.sha2(text(only), 256).alias("base_sha256"), text(F.col(spans)).alias("spans"))
