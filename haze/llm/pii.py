"""Personal data: candidate spans, boosted trees, calibrated redactions.

Everything on the data is DataFrame functions: no Python runs on executors.

1. Base spans: e-mail, ip, card and phone by their patterns and checks.
2. Generators with high recall propose further spans that may overlap: e-mail
   addresses with a written-out or bracketed at, runs of digits with up to three
   separators in between (phones without a plus, cards with other separators),
   long runs of letters, digits and key symbols (secrets).
3. Every candidate has small integer features of its format and context. The
   candidates of all documents are counted by feature vector in Spark; the
   features' ranges bound that table (``FEATURES``), and the driver boosts depth-2
   trees on the half of the documents whose crc32(id) is even. Labels are evidence
   that no feature shows: the plus of a phone, the top-level domain of an address,
   the checksum of a card, the assignment to a key's name of a secret.
4. Evidence is positive and unlabelled: most phones have no plus. The other half
   of the documents gives, per kind, the share c of true ones that carry the
   evidence (mean score of those that do), and the lowest score from which on the
   labelled share divided by c reaches ``precision`` is the threshold. A checksum
   also passes by chance, one number in ten: a card's labelled share is corrected
   for that, and an added card must pass the check itself.
5. One sweep over the spans sorted by start adds candidates that reach their
   threshold and overlap no base span; of two that overlap, the better score
   stays (a tie: the first). Base spans always stay.

Patterns are written without backtracking into runs, and spans carry their own
context and are swept in blocks, so long runs and texts with many matches cost
about linear time.

Defined results: a null or empty text has no spans (the digest of the empty
string); repeated rows give repeated rows; null ids stay null; other columns are
not read; without evidence of a kind nothing of it is added; an empty table gives
an empty result. Offsets are code points, the end is exclusive.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
ALL_KINDS = (*KINDS, "secret")  # a secret has no base form: it is found by its score only
_OPEN, _CLOSE, _OTHER = "\ue000", "\ue001", "\ue002"  # marks around matches; their own occurrences count as _OTHER
_LOCAL = "[A-Za-z0-9._%+-]"
_RUN = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++"  # a whole run, or what a match has left of it

BASE = {
    "email": rf"{_RUN}@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
GENERATORS = {
    "email": rf"{_RUN}(?:@|\x20?+[\[({{]\x20?+(?:at|AT|@)\x20?+[\])}}]\x20?+)[A-Za-z0-9-]++"
             r"(?:\x20?+(?:\.|[\[({]\x20?+(?:dot|DOT|\.)\x20?+[\])}])\x20?+[A-Za-z0-9-]++)++",
    "number": r"(?<![0-9])[0-9](?:[\x20()./-]{0,3}+[0-9])++",
    "secret": r"(?<![A-Za-z0-9_+/=-])[A-Za-z0-9_+/=-]{16,}+",
}
#: Feature -> number of values: the counted table has at most their product of rows.
FEATURES = {
    "number": {"digits": 9, "groups": 5, "first": 4, "last": 4, "separator": 6, "paren": 2, "left": 3, "right": 3, "context": 4},
    "email": {"labels": 5, "local": 4, "digit": 2, "left": 3, "right": 3, "context": 2},
    "secret": {"length": 6, "alphabet": 6, "share": 4, "right": 3},
}
# Context words and top-level domains.
_WORDS = {
    "phone": r"(?i)(?:phone|tel|call|mobile|cell|fax|whatsapp|sms|telefon|móvil|portable)\W*+$",
    "card": r"(?i)(?:card|visa|credit|debit|mastercard|amex|carte|tarjeta|karte)\W*+$",
    "other": r"(?i)(?:order|invoice|isbn|issn|version|ref|id|no|nr|page|build|sku|part|date|=)\W*+$",
    "email": r"(?i)(?:mail|contact|write|reach|kontakt|correo|courriel|to|at)\W*+$",
    "secret": r"(?i)(?:token|secret|password|passwd|pwd|api[_-]?key|private[_-]?key|access[_-]?key|auth)[\"']?\s*+[:=]\s*+[\"']?$",
}
_BLOCK = 64
_CHANCE = 0.1  # share of random numbers that pass the card checksum
_DOMAINS = "com org net edu gov mil int info biz io dev app co uk de fr es it nl eu us ca ch at be pt pl se no dk fi jp cn in br au ru mx ar".split()


def spans_of(text: Column, pattern: str) -> Column:
    """array<struct<s, e, m, before, after>> of the leftmost non-overlapping matches; text has no marks."""
    return _cut(F.regexp_replace(text, pattern, f"{_OPEN}$0{_CLOSE}"))


def _cut(marked: Column) -> Column:
    """Matches with up to 24 characters before them (not back into the match before) and one after."""
    none = F.array().cast("array<struct<s:int,e:int,m:string,before:string,after:string>>")

    def step(acc: Column, part: Column) -> Column:
        m = F.substring_index(part, _CLOSE, 1)
        end = acc["at"] + F.length(m)
        rest = F.substr(part, F.length(m) + 2)
        span = F.struct(acc["at"].alias("s"), end.alias("e"), m.alias("m"), acc["tail"].alias("before"), F.left(rest, F.lit(1)).alias("after"))
        return F.struct((acc["at"] + F.length(part) - 1).alias("at"), F.right(rest, F.lit(24)).alias("tail"),
                        F.concat(acc["out"], F.array(span)).alias("out"))
    zero = lambda at, tail: F.struct(at.alias("at"), tail.alias("tail"), none.alias("out"))

    def starts(parts: Column, blocks: Column) -> Column:
        """Offset and context before each block."""
        def over(acc: Column, block: Column) -> Column:
            last = F.element_at(block, -1)
            here = F.struct(acc["at"].alias("at"), acc["tail"].alias("tail"))
            size = F.aggregate(block, F.lit(0), lambda n, part: n + F.length(part) - 1)
            return F.struct((acc["at"] + size).alias("at"),
                            F.right(F.substr(last, F.length(F.substring_index(last, _CLOSE, 1)) + 2), F.lit(24)).alias("tail"),
                            F.concat(acc["out"], F.array(here)).alias("out"))
        begin = F.struct(F.length(parts[0]).alias("at"), F.right(parts[0], F.lit(24)).alias("tail"),
                         F.array().cast("array<struct<at:int,tail:string>>").alias("out"))
        return F.aggregate(blocks, begin, over, lambda acc: acc["out"])
    found = _let(F.split(marked, _OPEN, -1), lambda parts: _let(_blocks(parts, 2), lambda blocks: F.flatten(F.zip_with(
        blocks, starts(parts, blocks), lambda block, at: F.aggregate(block, zero(at["at"], at["tail"]), step, lambda acc: acc["out"])))))
    return F.when(F.contains(marked, F.lit(_OPEN)), found).otherwise(none)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once (the optimizer does not copy it into inner loops)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _blocks(items: Column, first: int) -> Column:
    """The array from its first-th item on, cut into blocks: Spark copies a loop's state at every
    step, so a state that grows by an item a step would cost the square of the items."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - first) / _BLOCK).cast("int")),
                       lambda k: F.slice(items, k * _BLOCK + first, F.lit(_BLOCK)))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    back = F.reverse(digits)

    def step(total: Column, i: Column) -> Column:
        d = F.substr(back, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + d - F.when(d > 9, 9).otherwise(0)
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return m.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?:\.|$)){4}$")
    if kind == "card":
        d = _digits(m)
        return F.length(d).between(14, 19) & luhn(d)
    if kind == "phone":
        return F.length(_digits(m)).between(10, 15)
    return F.lit(True)


# -- features ----------------------------------------------------------------

def _level(value: Column, *bounds: int) -> Column:
    """Number of bounds that the value reaches."""
    return sum(((value >= b).cast("int") for b in bounds), F.lit(0))


def _side(ch: Column) -> Column:
    return F.when(ch.rlike(r"[\p{L}_0-9]"), 1).when(ch.rlike(r"[=:#\"'/\\$%@]"), 2).otherwise(0)


def _left(c: Column) -> Column:
    return _side(F.right(c["before"], F.lit(1))).alias("left")


def _number(c: Column) -> Column:
    """Features and evidence of a run of digits; c has the digits ``d`` too."""
    d, m, before = c["d"], c["m"], c["before"]
    groups = F.split(m, "[^0-9]++", -1)
    separator = (F.when(m.rlike("^[0-9]++$"), 0).when(m.contains("/"), 5).when(m.contains("."), 4)
                 .when(m.contains("-") & m.contains(" "), 3).when(m.contains("-"), 2).otherwise(1))
    context = (F.when(before.rlike(_WORDS["phone"]), 1).when(before.rlike(_WORDS["card"]), 2)
               .when(before.rlike(_WORDS["other"]), 3).otherwise(0))
    n = F.length(d)
    checked = F.when(n.between(14, 19), luhn(d)).otherwise(False)
    return F.struct(
        c["s"].alias("s"), c["e"].alias("e"),
        _level(n, 7, 10, 11, 12, 14, 16, 17, 20).alias("digits"), _level(F.size(groups), 2, 3, 4, 5).alias("groups"),
        _level(F.length(groups[0]), 3, 4, 5).alias("first"), _level(F.length(F.element_at(groups, -1)), 3, 4, 5).alias("last"),
        separator.alias("separator"), m.rlike("[()]").cast("int").alias("paren"), _left(c), _side(c["after"]).alias("right"),
        context.alias("context"), n.between(10, 15).alias("can_phone"), checked.alias("can_card"),
        (n.between(10, 15) & before.rlike(r"\+\(?+$")).cast("int").alias("is_phone"),
        checked.cast("int").alias("is_card"))


def _email(c: Column) -> Column:
    host = F.regexp_replace(c["m"], r"(?i)\x20?+[\[({]\x20?+dot\x20?+[\])}]\x20?+", ".")
    labels = F.split(F.regexp_replace(host, r"^.*?(?:@|(?i:at))", ""), r"\.", -1)
    local = F.regexp_extract(c["m"], f"^{_LOCAL}++", 0)
    return F.struct(
        c["s"].alias("s"), c["e"].alias("e"),
        _level(F.size(labels), 2, 3, 4, 5).alias("labels"), _level(F.length(local), 2, 9, 25).alias("local"),
        local.rlike("[0-9]").cast("int").alias("digit"), _left(c), _side(c["after"]).alias("right"),
        c["before"].rlike(_WORDS["email"]).cast("int").alias("context"), F.lit(True).alias("can_email"),
        c["m"].rlike(rf"(?i)[.)\x20](?:{'|'.join(_DOMAINS)})$").cast("int").alias("is_email"))


def _secret(c: Column) -> Column:
    m = c["m"]
    alphabet = (F.when(m.rlike("^(?:[a-z]++|[A-Z]++)$"), 0).when(m.rlike("^[0-9]++$"), 4).when(m.rlike("^[A-Za-z]++$"), 1)
                .when(m.rlike("^(?:[0-9a-f]++|[0-9A-F]++)$"), 2).when(m.rlike("^[A-Za-z0-9]++$"), 3).otherwise(5))
    return F.struct(
        c["s"].alias("s"), c["e"].alias("e"), _level(F.length(m), 20, 24, 32, 40, 64).alias("length"), alphabet.alias("alphabet"),
        _level(F.length(c["d"]) * 10 / F.length(m), 1, 3, 5).alias("share"), _side(c["after"]).alias("right"),
        (F.length(c["d"]) < F.length(m)).alias("can_secret"), c["before"].rlike(_WORDS["secret"]).cast("int").alias("is_secret"))


_SCHEMES = (("number", _number, ("phone", "card")), ("email", _email, ("email",)), ("secret", _secret, ("secret",)))


def _candidates(frame: DataFrame) -> DataFrame:
    """Adds, per generator, the candidates with their features, evidence and the kinds that they can be."""
    def digits(c: Column) -> Column:
        return F.struct(c["s"].alias("s"), c["e"].alias("e"), c["m"].alias("m"), c["before"].alias("before"), c["after"].alias("after"),
                        _digits(c["m"]).alias("d"))

    def kept(name: str) -> Column:
        found = F.transform(f"g_{name}", digits)
        return F.filter(found, lambda c: F.length(c["d"]) >= 7) if name == "number" else found
    return frame.withColumns({f"c_{name}": F.transform(kept(name), features) for name, features, _ in _SCHEMES})


def _spanned(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text_, an array of base spans per kind and of raw candidates per generator."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    marked = F.when(F.contains(text, F.lit(_OPEN)) | F.contains(text, F.lit(_CLOSE)),
                    F.translate(text, _OPEN + _CLOSE, _OTHER + _OTHER)).otherwise(text)
    frame = docs.select(F.col(id_col).cast("long").alias("doc_id"), marked.alias("text_"))
    patterns = BASE | {f"g_{k}": v for k, v in GENERATORS.items()}
    frame = frame.withColumns({k: F.regexp_replace("text_", p, f"{_OPEN}$0{_CLOSE}") for k, p in patterns.items()})
    frame = frame.withColumns({k: _cut(F.col(k)) for k in patterns})
    checked = lambda kind: F.filter(kind, lambda c: _valid(kind, c["m"]))
    return frame.withColumns({k: checked(k) for k in KINDS if k != "email"})


# -- boosted trees on the counted feature vectors ----------------------------

Tree = tuple  # (feature, level, left, right); a leaf is a float


def _leaf(rows: list[int], grad: list[float], hess: list[float]) -> float:
    g, h = sum(grad[i] for i in rows), sum(hess[i] for i in rows)
    return -g / (h + 1.0)


def _split(rows, x, sizes, grad, hess, depth):
    """Best tree of this depth over the rows, by the second-order gain."""
    g, h = sum(grad[i] for i in rows), sum(hess[i] for i in rows)
    best, choice = 1e-6, None
    for f, size in enumerate(sizes):
        by = [[0.0, 0.0] for _ in range(size)]
        for i in rows:
            by[x[i][f]][0] += grad[i]
            by[x[i][f]][1] += hess[i]
        gl = hl = 0.0
        for level in range(size - 1):
            gl, hl = gl + by[level][0], hl + by[level][1]
            gain = gl * gl / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g * g / (h + 1)
            if gain > best:
                best, choice = gain, (f, level)
    if choice is None or depth == 0:
        return _leaf(rows, grad, hess)
    f, level = choice
    low, high = [i for i in rows if x[i][f] <= level], [i for i in rows if x[i][f] > level]
    return f, level, _split(low, x, sizes, grad, hess, depth - 1), _split(high, x, sizes, grad, hess, depth - 1)


def _value(tree, row) -> float:
    while not isinstance(tree, float):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


class Boosted:
    """bias, trees and threshold of one kind; threshold None: nothing is added."""

    def __init__(self, names: list[str], bias: float, trees: list, threshold: float | None):
        self.names, self.bias, self.trees, self.threshold = names, bias, trees, threshold

    def score(self, c: Column) -> Column:
        def column(tree) -> Column:
            if isinstance(tree, float):
                return F.lit(tree)
            f, level, low, high = tree
            return F.when(c[self.names[f]] <= level, column(low)).otherwise(column(high))
        return sum((column(t) for t in self.trees), F.lit(self.bias))


def boost(counted: list[tuple], sizes: dict[str, int], rounds: int = 16, rate: float = 0.5, precision: float = 0.9,
          chance: float = 0.0) -> Boosted:
    """counted: (feature vector, candidates, labelled, candidates of the held-out half, labelled ones of it), one
    entry per distinct vector. chance: share of untrue candidates that are labelled all the same."""
    names = list(sizes)
    n, pos, held_n, held_pos = ([float(c[k]) for c in counted] for k in range(1, 5))
    x = [c[0] for c in counted]
    total, yes = sum(n), sum(pos)
    if not yes or not sum(held_pos):
        return Boosted(names, 0.0, [], None)
    bias = math.log((yes + 0.5) / (total - yes + 0.5))
    z, trees = [bias] * len(x), []
    for _ in range(rounds):
        p = [_sigmoid(v) for v in z]
        grad, hess = [n[i] * p[i] - pos[i] for i in range(len(x))], [n[i] * p[i] * (1 - p[i]) for i in range(len(x))]
        tree = _split(list(range(len(x))), x, list(sizes.values()), grad, hess, 2)
        if isinstance(tree, float):
            break
        tree = _scaled(tree, rate)
        trees.append(tree)
        z = [v + _value(tree, row) for v, row in zip(z, x)]
    levels: dict[float, list[float]] = {}  # held-out candidates and labelled ones by score
    for v, k, good in zip(z, held_n, held_pos):
        level = levels.setdefault(round(v, 9), [0.0, 0.0])
        level[0], level[1] = level[0] + k, level[1] + good
    order = [(v, *levels[v]) for v in sorted(levels, reverse=True) if levels[v][0]]
    # share of the true ones that carry the evidence; where it also comes by chance, every true one does
    c = 1.0 if chance else sum(good * good / k for k, good in _falling([(k, good) for _, k, good in order])) / sum(held_pos)
    threshold, seen, good = None, 0.0, 0.0
    for v, k, labelled in order:
        seen, good = seen + k, good + labelled
        if good and _true_share(good / (seen + 2), c, chance) >= precision:  # two unseen untrue ones: few rows prove little
            threshold = v - 1e-6
    return Boosted(names, bias, trees, threshold)


def _sigmoid(v: float) -> float:
    return 1 / (1 + math.exp(-max(min(v, 30), -30)))


def _falling(levels: list[tuple[float, float]]) -> list[list[float]]:
    """(candidates, labelled) by falling score, neighbours pooled until the labelled share falls with the score."""
    pools: list[list[float]] = []
    for n, good in levels:
        pools.append([n, good])
        while len(pools) > 1 and pools[-1][1] * pools[-2][0] >= pools[-2][1] * pools[-1][0]:
            n, good = pools.pop()
            pools[-1] = [pools[-1][0] + n, pools[-1][1] + good]
    return pools


def _true_share(labelled: float, c: float, chance: float) -> float:
    """Share of true ones among candidates of which ``labelled`` carry the evidence; where it also comes by
    chance, among those that carry it (only these are added)."""
    if chance:
        return max(labelled - chance, 0.0) / (1 - chance) / labelled
    return labelled / c


def _scaled(tree, rate: float):
    return tree * rate if isinstance(tree, float) else (tree[0], tree[1], _scaled(tree[2], rate), _scaled(tree[3], rate))


def fit(candidates: DataFrame, precision: float = 0.9) -> dict[str, Boosted]:
    """Models by kind, from the counts of all documents' candidates."""
    models = {}
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2, F.lit(0)) == 1
    for name, _, kinds in _SCHEMES:
        sizes = FEATURES[name]
        rows = candidates.select(held.alias("held"), F.explode(f"c_{name}").alias("c")).select("held", "c.*")
        sums = []
        for kind in kinds:
            able = F.col("digits").between(5, 7) if kind == "card" else F.col(f"can_{kind}")  # 14 to 19 digits, whatever the checksum
            for half in (False, True):
                mine = able & (F.col("held") == half)
                sums += [F.count_if(mine).alias(f"n_{kind}_{half}"), F.sum(F.when(mine, F.col(f"is_{kind}")).otherwise(0)).alias(f"is_{kind}_{half}")]
        counted = rows.groupBy(*sizes).agg(*sums).collect()
        for kind in kinds:
            table = [(tuple(r[f] for f in sizes), *(r[f"{v}_{kind}_{half}"] for half in (False, True) for v in ("n", "is"))) for r in counted]
            models[kind] = boost(sorted(t for t in table if t[1] or t[3]), sizes, precision=precision, chance=_CHANCE if kind == "card" else 0.0)
    return models


# -- the operator ------------------------------------------------------------

_ITEM = "struct<s:int,k:int,e:int,kind:string,z:double>"


def _swept(items: Column) -> Column:
    """The items with a score that overlap no item without one, nor a better one next to them; items sorted by start."""
    def step(acc: Column, c: Column) -> Column:
        out, n = acc["out"], F.size(acc["out"])
        last = F.get(out, n - 1)
        clash = F.coalesce(last["e"] > c["s"], F.lit(False))
        shorter = F.slice(out, F.lit(1), F.greatest(n - 1, F.lit(0)))
        base = F.when(clash, shorter).otherwise(out)
        cand = (F.when(c["s"] < acc["end"], out).when(~clash, F.concat(out, F.array(c)))
                .when(c["z"] > last["z"], F.concat(shorter, F.array(c))).otherwise(out))
        return F.struct(F.when(c["z"].isNull(), F.greatest(acc["end"], c["e"])).otherwise(acc["end"]).alias("end"),
                        F.when(c["z"].isNull(), base).otherwise(cand).alias("out"))

    def over(acc: Column, block: Column) -> Column:
        n = F.size(acc["out"])
        begin = F.struct(acc["end"].alias("end"), F.slice(acc["out"], F.greatest(n, F.lit(1)), F.lit(1)).alias("out"))
        return _let(F.aggregate(block, begin, step), lambda done: F.struct(
            done["end"].alias("end"), F.concat(F.slice(acc["out"], F.lit(1), F.greatest(n - 1, F.lit(0))), done["out"]).alias("out")))
    zero = F.struct(F.lit(0).alias("end"), F.array().cast(f"array<{_ITEM}>").alias("out"))
    return F.aggregate(_let(items, lambda all_: _blocks(all_, 1)), zero, over, lambda acc: acc["out"])


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", precision: float = 0.9) -> DataFrame:
    """doc_id and, per row, ``base`` and ``added``: arrays of (s, k, e, kind) sorted by start, then kind."""
    frame = _candidates(_spanned(docs, id_col, text_col))
    models = fit(frame, precision)
    span = "array<struct<s:int,k:int,e:int,kind:string>>"

    def item(c: Column, kind: str, z: Column) -> Column:
        return F.struct(c["s"].alias("s"), F.lit(ALL_KINDS.index(kind)).alias("k"), c["e"].alias("e"), F.lit(kind).alias("kind"), z.alias("z"))

    def named(kind: str) -> Column:
        return F.transform(kind, lambda c: item(c, kind, F.lit(None).cast("double"))).cast(f"array<{_ITEM}>")

    def chosen(source: str, kind: str) -> Column:
        model = models[kind]
        if model.threshold is None:
            return F.array().cast(f"array<{_ITEM}>")
        able = F.filter(f"c_{source}", lambda c: c[f"can_{kind}"])
        scored = F.transform(able, lambda c: item(c, kind, model.score(c))).cast(f"array<{_ITEM}>")
        return F.filter(scored, lambda c: c["z"] >= model.threshold)
    base = F.array_sort(F.concat(*(named(k) for k in KINDS)))
    more = F.concat(*(chosen(name, kind) for name, _, kinds in _SCHEMES for kind in kinds))
    frame = frame.select("doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS), base.alias("base"), more.alias("more"))
    plain = lambda c: F.struct(c["s"].alias("s"), c["k"].alias("k"), c["e"].alias("e"), c["kind"].alias("kind"))
    added = F.when(F.size("more") > 0, _swept(F.array_sort(F.concat("base", "more")))).otherwise(F.col("more"))
    return frame.select("doc_id", *(f"n_{k}" for k in KINDS), F.transform("base", plain).cast(span).alias("base"),
                        F.transform(added, plain).cast(span).alias("added"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda c: F.concat_ws(":", c["kind"], c["s"].cast("string"), c["e"].cast("string"))), ",")


def pii_report(docs: DataFrame) -> DataFrame:
    """The contract's columns (``spans``: the four kinds), then the numbers of added spans of these kinds and of
    secrets, and the secrets' spans."""
    found = find_pii(docs)
    of = lambda secret: F.filter("added", lambda c: (c["kind"] == "secret") == secret)
    return found.select("doc_id", *(f"n_{k}" for k in KINDS), F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
                        _joined(F.array_sort(F.concat(F.col("base"), of(False)))).alias("spans"), F.size(of(False)).cast("long").alias("n_added"),
                        F.size(of(True)).cast("long").alias("n_secret"), _joined(of(True)).alias("secret_spans"))


def redact(text: Column, spans: Column) -> Column:
    """The text with each of the sorted, non-overlapping spans (s, k, e, kind) replaced by ``<KIND>``."""
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = F.aggregate(spans, zero, lambda acc, c: F.struct(
        c["e"].alias("at"), F.concat(acc["out"], F.substr(text, acc["at"] + 1, c["s"] - acc["at"]), F.lit("<"), F.upper(c["kind"]),
                                     F.lit(">")).alias("out")))
    return F.concat(done["out"], F.substr(text, done["at"] + 1, F.length(text)))
