"""Personal data by candidate gradient boosting, in DataFrame functions alone.

Strict patterns give the base spans, which always stay. High-recall generators propose further spans, which may
overlap; boosted trees score each one by its format and context, as one sum of CASE expressions; a span joins
the result where its score reaches the threshold that was calibrated for its kind, less what other spans cover.

The trees are trained on the driver. As no table labels spans, their examples are made from a fixed seed.
"""

from __future__ import annotations

import random
import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .gbt import Trainer, Trees
from .spans import RUN, fold, let, markless, matches, none

#: Kinds in the order in which spans of one start are listed; the first four are the base's.
KINDS = ("email", "ip", "card", "phone", "ssn", "secret")

#: The base's patterns. Possessive repeats and the look-behind only spare Java needless steps: from a later start in the same run of
#: characters a match would have to go on as from the first. \G lets one begin where the last ended. Runs of less than 12 digits
#: are no cards, and a longer one is matched whole from its first digit either way, so the card's pattern passes them over.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9]){11,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}

#: The generators of further candidates, as (kind, pattern, a test that texts without any candidate mostly fail).
GENERATORS = (
    ("phone", r"(?<![0-9+])(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])", "[0-9]"),
    ("card", r"(?<![0-9])[0-9](?:[ -]?[0-9]){11,18}(?![0-9])", "[0-9]"),
    ("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "[0-9]-[0-9]"),
    ("secret", r"(?i)(?:token|secret|api[_-]?key|password|passwd|bearer)[\"']? {0,3}[=:] {0,3}[\"']?[A-Za-z0-9+/_-]{12,}+", "(?i)token|secret|key|passw|bearer"),
    ("email", r"[A-Za-z0-9._%+-]{1,64} ?[\[(]at[\])] ?[A-Za-z0-9-]{1,63}(?: ?[\[(]dot[\])] ?|\.)[A-Za-z]{2,24}", r"[\[(]at[\])]"),
    ("ip", r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])", "[0-9A-Fa-f]:[0-9A-Fa-f]"),
)
CONTEXT = 24
#: Words before a span that speak for its kind, in English, German, French and Spanish; and words that speak against any.
HINTS = {
    "phone": "phone|tel|call|mobile|cell|fax|whatsapp|contact|number|anruf|handy|mobil|rufnummer|nummer|appel|portable|num[eé]ro|llam|m[oó]vil|celular",
    "card": "card|visa|mastercard|amex|credit|debit|pan|karte|kredit|carte|cr[eé]dit|tarjeta",
    "ssn": "ssn|social|security|taxpayer|sozial|steuer|s[eé]curit[eé]|seguridad|fiscal",
    "secret": "token|secret|key|password|bearer|passwort|kennwort|schl[uü]ssel|mot de passe|contrase[nñ]a|clave",
    "email": "mail|contact|write|reach|schreib|kontakt|[eé]cri|correo|escrib",
    "ip": "ip|host|addr|server|from|adresse|serveur|servidor|direcci[oó]n",
}
AGAINST = "order|invoice|ticket|ref|version|isbn|serial|item|sku|page|table|figure|row|batch|bestell|rechnung|seite|tabelle|commande|facture|tableau|pedido|factura|p[aá]gina|tabla"
FEATURES = ("kind", "chars", "digits", "gaps", "parens", "luhn", "first", "distinct", "hint", "against", "letters", "before", "after")


def luhn(digits: Column) -> Column:
    """Does a string of digits pass the check sum? From the right, every second digit is doubled, less 9 beyond 9."""
    number = F.transform(F.split(F.reverse(digits), ""), lambda d: F.coalesce(d.try_cast("int"), F.lit(0)))
    each = F.transform(number, lambda d, i: F.when(i % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _bound(f: Callable[..., Column], *first: object) -> Callable[[Column], Column]:
    return lambda x: f(*first, x)


def _named(order: int, kind: str) -> Callable[[Column], Column]:
    return lambda m: F.struct(m["start"].alias("start"), F.lit(order).alias("order"), m["end"].alias("end"), F.lit(kind).alias("kind"))


def _keyed(named: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda m: F.struct(m["start"].alias("start"), (-m["end"]).alias("back"), *(named(m)[c].alias(c) for c in ("order", "end", "kind")))


def _base_ok(kind: str, match: Column) -> Column:
    value = match["value"]
    n = F.char_length(_digits(value))
    if kind == "ip":
        part = lambda p: let(F.regexp_replace(p, "^0+", ""), lambda q: (F.char_length(q) < 4) & (F.concat(F.lit("0"), F.substring(q, 1, 3)).cast("int") < 256))
        return F.forall(F.split(value, "\\."), part)
    if kind == "card":
        return F.when(n.between(12, 19), luhn(_digits(value))).otherwise(F.lit(False))
    return n.between(9, 15) if kind == "phone" else F.lit(True)


def base_spans(text: Column) -> Column:
    """array of (start, order, end, kind), sorted."""
    out = []
    for order, (kind, pattern) in enumerate(BASE.items()):
        need = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+"))}.get(kind, text.rlike("[0-9][ .-]?[0-9]"))
        found = F.when(need, matches(text, pattern)).otherwise(none())
        out.append(F.transform(F.filter(found, _bound(_base_ok, kind)), _named(order, kind)))
    return F.array_sort(F.concat(*out))


def _features(kind: str, c: Column) -> list[Column]:
    value, left = c["value"], F.lower(c["left"])
    digits = _digits(value)
    flag = lambda x: F.when(x, 1.0).otherwise(0.0)
    count = lambda pattern: F.char_length(F.regexp_replace(value, pattern, "")).cast("double")
    return [
        F.lit(float(KINDS.index(kind))),
        F.char_length(value).cast("double"),
        F.char_length(digits).cast("double"),
        count("[^ .-]"),
        flag(F.contains(value, F.lit("("))),
        flag(luhn(digits)),
        F.coalesce(F.substring(digits, 1, 1).try_cast("double"), F.lit(-1.0)),
        F.size(F.array_distinct(F.split(digits, ""))).cast("double"),
        flag(left.rlike(HINTS[kind])),
        flag(left.rlike(AGAINST)),
        count("[^A-Za-z]"),
        flag(c["left"].rlike("[A-Za-z0-9]$")),
        flag(c["right"].rlike("^[A-Za-z0-9]")),
    ]


def features_of(kind: str, value: str, left: str, right: str) -> list[float]:
    """The same features of one example, for training."""
    digits = re.sub("[^0-9]", "", value)
    total = sum(int(d) if i % 2 == 0 else int(d) * 2 - 9 * (int(d) > 4) for i, d in enumerate(reversed(digits)))
    low = left[-CONTEXT:].lower()
    return [
        float(KINDS.index(kind)),
        float(len(value)),
        float(len(digits)),
        float(len(re.findall("[ .-]", value))),
        float("(" in value),
        float(total % 10 == 0),
        float(digits[0]) if digits else -1.0,
        float(max(1, len(set(digits)))),
        float(bool(re.search(HINTS[kind], low))),
        float(bool(re.search(AGAINST, low))),
        float(len(re.findall("[A-Za-z]", value))),
        float(bool(re.search("[A-Za-z0-9]$", left))),
        float(bool(re.search("^[A-Za-z0-9]", right))),
    ]


@dataclass(frozen=True)
class Model:
    trees: Trees
    #: Of each kind, the least margin of a span that is taken.
    thresholds: dict[str, float]


def examples(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Made-up candidates, half of them personal data: plausible formats and contexts against ids, sums and versions."""
    r = random.Random(seed)
    run = lambda k, of="0123456789": "".join(r.choice(of) for _ in range(k))
    told = {"phone": ["call me at ", "tel: ", "phone number ", "mobile ", "fax: ", "handy ", "num\u00e9ro ", "llame al "], "card": ["card ", "visa ", "credit card: ", "karte ", "carte ", "tarjeta "], "ssn": ["ssn ", "social security: ", "seguridad social "], "secret": [""], "email": ["mail ", "reach me: ", "", "write to ", "correo "], "ip": ["host ", "from ", "", "server addr ", "serveur "]}
    other = ["order ", "invoice no ", "ticket ", "ref: ", "serial ", "item ", "page ", "in ", "about ", "of the ", "total ", "rechnung ", "facture ", "pedido ", "und ", "des ", "por "]
    x, y = [], []
    for _ in range(n):
        kind, good = r.choice(KINDS), r.random() < 0.5
        if kind == "phone":
            value = r.choice([f"({run(3)}) {run(3)}-{run(4)}", f"{run(3)}-{run(3)}-{run(4)}", f"{run(3)}.{run(3)}.{run(4)}"]) if good else r.choice([f"{run(4)} {run(3)} {run(3)}", f"{run(2)}.{run(3)}{run(3)}", f"{run(4)}-{run(4)}{run(4)}", f"{run(3)} {run(4)}{run(4)}"])
        elif kind == "card":
            value = r.choice("3456") + run(3) + "".join(" " + run(4) for _ in range(3)) if good else run(r.randint(12, 19))
        elif kind == "ssn":
            value = f"{run(3)}-{run(2)}-{run(4)}"
        elif kind == "secret":
            head = r.choice(["token = ", "api_key: ", "password=", 'secret = "'])
            value = head + (run(r.randint(20, 48), "0123456789abcdef") if good else run(r.randint(12, 20), "abcdefghijklmnop_"))
        elif kind == "email":
            value = f"{run(6, 'abcde')} (at) {run(5, 'fghij')}{r.choice(['.', ' (dot) '])}{r.choice(['com', 'org'])}"
        else:
            value = ":".join(run(4, "0123456789abcdef") if good else run(2) for _ in range(8))
        hinted = told[kind] if good else other
        bare = kind in ("phone", "secret", "email", "ip") and good and r.random() < 0.4
        left = run(8, "abc ") + (" " if bare else r.choice(hinted))
        cut = not good and kind == "email"
        x.append(features_of(kind, value, left + "x" * cut, "" if good or r.random() < 0.7 else "x7"))
        y.append(float(good))
    return np.array(x), np.array(y)


@lru_cache(maxsize=1)
def train(n: int = 6_000, seed: int = 20, precision: float = 0.99) -> Model:
    """Trees from one half of the made-up candidates; from the other, the least threshold of the given precision for each kind."""
    x, y = examples(n, seed)
    half = n // 2
    trees = Trainer(trees=24, depth=3, rate=0.3).fit(x[:half], y[:half])
    margin = trees.margin(x[half:])
    thresholds = {}
    for k, kind in enumerate(KINDS):
        mine = x[half:, 0] == k
        order = np.argsort(-margin[mine])
        right = np.cumsum(y[half:][mine][order]) / np.arange(1, mine.sum() + 1)
        ok = np.flatnonzero(right >= precision)
        thresholds[kind] = max(0.0, float(margin[mine][order][ok[-1]])) if len(ok) else float("inf")
    return Model(trees, thresholds)


def _score(trees: Trees, x: Column) -> Column:
    """The trees' margin for an array of features, as nested CASE expressions."""

    def node(i: int) -> Column:
        if trees.left[i] == i:
            return F.lit(float(trees.value[i]))
        test = F.element_at(x, int(trees.feature[i]) + 1) <= float(trees.threshold[i])
        return F.when(test, node(trees.left[i])).otherwise(node(trees.right[i]))

    total = F.lit(float(trees.bias))
    for root in trees.roots:
        total = total + node(root)
    return total


def _taken(model: Model, kind: str, c: Column) -> Column:
    return let(F.array(*_features(kind, c)), lambda x: _score(model.trees, x) >= model.thresholds[kind])


_SPAN = "struct<start:int,order:int,end:int,kind:string>"


def _span(start: Column, order: Column, end: Column, kind: Column) -> Column:
    return F.struct(start.cast("int").alias("start"), order.cast("int").alias("order"), end.cast("int").alias("end"), kind.cast("string").alias("kind"))


def _some(span: Column) -> Column:
    """An array of the span, or of none if it is empty."""
    return F.when(span["start"] < span["end"], F.array(span)).otherwise(_nothing())


def _nothing() -> Column:
    return F.from_json(F.lit("[]"), f"array<{_SPAN}>")


def candidates(text: Column, model: Model) -> Column:
    """What the trees take, by start, then the longer, then the kind listed first: array of (start, back, order, end, kind), with back = -end."""
    out = []
    for kind, pattern, need in GENERATORS:
        named = _named(KINDS.index(kind), kind)
        found = F.when(text.rlike(need), matches(text, pattern, CONTEXT)).otherwise(none(True))
        out.append(F.transform(F.filter(found, _bound(_taken, model, kind)), _keyed(named)))
    return F.array_sort(F.concat(*out))


def covered(cands: Column) -> Column:
    """Spans that don't overlap and cover what the candidates cover, in order.

    From the left, a candidate that overlaps no whole one before it is a whole one. The others all begin within the last whole one, so
    what they reach beyond it, up to the next whole one, is a further span, of the kind of the one that reaches farthest.
    """

    def gap(at: Column, until: Column) -> Column:
        return _span(at["end"], at["order"], F.least(until, at["reach"]), at["kind"])

    def step(at: Column, c: Column) -> tuple[Column, Column]:
        new = c["start"] >= at["end"]
        farther = c["end"] > at["reach"]
        after = F.struct(F.when(new, c["end"]).otherwise(at["end"]).alias("end"), F.greatest(c["end"], at["reach"]).alias("reach"), F.when(farther, c["order"]).otherwise(at["order"]).alias("order"), F.when(farther, c["kind"]).otherwise(at["kind"]).alias("kind"))
        return after, F.when(new, F.concat(_some(gap(at, c["start"])), F.array(_span(c["start"], c["order"], c["end"], c["kind"])))).otherwise(_nothing())

    begin = F.struct(F.lit(0).alias("end"), F.lit(0).alias("reach"), F.lit(0).alias("order"), F.lit("").alias("kind"))
    return let(fold(cands, begin, _nothing(), step), lambda f: F.concat(f["out"], _some(gap(f["state"], f["state"]["reach"]))))


def without(pieces: Column, base: Column) -> Column:
    """What is left of ``pieces``, which don't overlap, where no span of ``base`` is; both are sorted."""
    tagged = lambda first: lambda s: F.struct(s["start"].alias("start"), F.lit(first).alias("tag"), _span(s["start"], s["order"], s["end"], s["kind"]).alias("span"))
    both = F.array_sort(F.concat(F.transform(base, tagged(0)), F.transform(pieces, tagged(1))))

    def step(at: Column, x: Column) -> tuple[Column, Column]:
        """The state is how far base spans reach, and what is left of the last piece."""
        is_base, span, left = x["tag"] == 0, x["span"], at["left"]
        rest = _span(F.greatest(left["start"], span["end"]), left["order"], left["end"], left["kind"])
        piece = _span(F.greatest(span["start"], at["reach"]), span["order"], span["end"], span["kind"])
        after = F.struct(F.when(is_base, F.greatest(at["reach"], span["end"])).otherwise(at["reach"]).alias("reach"), F.when(is_base, rest).otherwise(piece).alias("left"))
        return after, _some(_span(left["start"], left["order"], F.when(is_base, F.least(left["end"], span["start"])).otherwise(left["end"]), left["kind"]))

    begin = F.struct(F.lit(0).alias("reach"), _span(F.lit(0), F.lit(0), F.lit(0), F.lit("")).alias("left"))
    return let(fold(both, begin, _nothing(), step), lambda f: F.concat(f["out"], _some(f["state"]["left"])))


def find(docs: DataFrame, model: Model | None = None, text: str = "text") -> DataFrame:
    """Append ``pii_base`` and ``pii``: arrays of (start, order, end, kind), sorted by start and kind.

    ``pii`` has the base spans and those that the method adds, which overlap no other. Offsets count code points; ends are exclusive. A null or empty text has
    none. All rows and columns stay, but two of these names, which are replaced. It is one projection of built-in functions, without a shuffle.
    """
    found = _found(docs, model, text)
    names = [c for c in docs.columns if c not in ("pii", "pii_base")]
    return found.select(*(F.col("_row").getField(c).alias(c) for c in names), F.col("_pii.base").alias("pii_base"), F.col("_pii.every").alias("pii"))


def _found(docs: DataFrame, model: Model | None, text: str) -> DataFrame:
    """_row, all columns as one, and _pii, the spans of the base and of all."""
    model = model or train()
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), markless(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("_text"))

    # Steps of their own: as one expression, analysis takes many times longer.
    parts = rows.select("_row", base_spans(F.col("_text")).alias("_base"), candidates(F.col("_text"), model).alias("_cands"))
    few = F.size("_cands") == 0
    parts = parts.select("*", F.when(few, _nothing()).otherwise(covered(F.col("_cands"))).alias("_pieces"))
    parts = parts.select("*", F.when(few | (F.size("_base") == 0), F.col("_pieces")).otherwise(without(F.col("_pieces"), F.col("_base"))).alias("_more"))
    every = F.when(few, F.col("_base")).otherwise(F.array_sort(F.concat("_base", "_more")))
    return parts.select("_row", F.struct(F.col("_base").alias("base"), every.alias("every")).alias("_pii"))


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span, or run of overlapping spans, replaced by the first one's kind in brackets; null stays null."""

    def merge(last: Column, s: Column) -> tuple[Column, Column]:
        more = s["start"] < last["end"]
        longer = _span(last["start"], last["order"], F.greatest(last["end"], s["end"]), last["kind"])
        return F.when(more, longer).otherwise(_span(s["start"], s["order"], s["end"], s["kind"])), F.when(more, _nothing()).otherwise(_some(last))

    def some(runs: Column, g: Column) -> Column:
        """The text up to the end of some runs, from that of those before them; a substring of the whole text is cut but once for them."""
        group = F.slice(runs, g * RUN + 1, RUN)
        begin = F.coalesce(F.get(runs, g * RUN - 1)["end"], F.lit(0))
        cut = F.substring(text, begin + 1, F.element_at(group, -1)["end"] - begin)

        def each(block: Column) -> Column:
            before = lambda i: F.coalesce(F.get(group, i - 1)["end"], begin)
            return F.array_join(F.transform(group, lambda s, i: F.concat(F.substring(block, before(i) - begin + 1, s["start"] - before(i)), F.lit("["), F.upper(s["kind"]), F.lit("]"))), "")

        return let(cut, each)

    def build(runs: Column) -> Column:
        groups = F.sequence(F.lit(0), F.floor((F.size(runs) - 1) / RUN).cast("int"))
        rest = F.substring(text, F.element_at(runs, -1)["end"] + 1, F.char_length(text))
        return F.concat(F.array_join(F.transform(groups, lambda g: some(runs, g)), ""), rest)

    merged = let(fold(spans, _span(F.lit(0), F.lit(0), F.lit(0), F.lit("")), _nothing(), merge), lambda f: F.concat(f["out"], _some(f["state"])))
    return F.when(F.size(spans) == 0, text).otherwise(let(merged, build))


def redact(docs: DataFrame, model: Model | None = None, text: str = "text") -> DataFrame:
    """The same rows and columns with all personal data in ``text`` replaced by its kind in brackets; see :func:`find`."""
    clean = redacted(F.col("_row").getField(text), F.col("_pii.every"))
    return _found(docs, model, text).select(*((clean if c == text else F.col("_row").getField(c)).alias(c) for c in docs.columns))
