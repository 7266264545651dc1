"""Personal data: candidate spans, boosted trees, calibrated selection, redaction.

Base rules give spans that always stay. Generators of high recall propose more,
which may overlap and have no upper length. Each candidate is described by bits
of its format and context. Where a strict rule can judge a candidate its outcome
is a training label: a checksum, a range, a number of digits; for secrets, which
are random strings, a key word right before them. What such a rule looks at is
masked out of the bits of its kind (MASK): a phone is learned without its plus
sign, a secret from its format alone. So the trees also score candidates that no
rule can judge, by those of the same format that one did, or that fail it by a
typing error. Depth-two trees are boosted on one half of the texts; for
each kind the lowest score that keeps the wanted precision on the other half, by
a Wilson lower bound, is the threshold. Copies of a text fall into one half.

Main path: DataFrame functions only. Counts by combination of bits come to the
driver, at most 2 ** BITS of each kind whatever the number of documents; the
trees are fitted on them there and go back as a SQL expression."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kinds in the order of output; the last has no base rule.
KINDS = ("email", "ip", "card", "phone", "secret")
#: Base rules for Java's engine. They match what these plain patterns match (fixed values),
#:   email [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
#:   ip [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
#:   card [0-9]([\x20-]?[0-9])+
#:   phone \+[0-9][\x20().0-9-]+[0-9]
#: but try a run of characters from its first one only and never go back into it: time stays linear, the stack flat.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Generators of further candidates.
WIDE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++ ?(?:@|\[at\]|\(at\)) ?[A-Za-z0-9-]++(?: ?(?:\.|\[dot\]|\(dot\)) ?[A-Za-z0-9-]++)*+",
    "ip": r"(?<![0-9.])[0-9]++(?:\.[0-9]++){3,}+",
    "card": r"(?<![0-9])[0-9](?:[ .-]?[0-9]){11,}+",
    "phone": r"(?<![0-9+().-])[+(]{0,2}+[0-9][ ().0-9-]{6,}+",
    "secret": r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{24,}+",
}
#: What a match of a generator ends with but its candidate does not.
TAIL = {"phone": " ().-"}
#: Cheap tests that a text can hold a match at all.
NEEDS = {"email": "text rlike '@|[(\\\\[]at[)\\\\]]'", "ip": "text rlike '[0-9][.][0-9]'", "card": "text rlike '[0-9]'", "phone": "text rlike '[0-9]'", "secret": "text rlike '[0-9A-Za-z_-]{24}'"}
WORDS = "mail|tel|phone|fon|call|card|konto|credit|host|addr|server|token|key|secret|passw|contact"
#: Bits of a candidate: c is its text, pre and post are what stands before and after it.
FEATURES = (
    "startswith(c, '+')", "c rlike '[ -]'", "contains(c, '(')", "c rlike '[.].*[.].*[.]'", "digits >= 8", "digits >= 10", "digits >= 14", "digits = 16", "digits > 16",
    "c rlike '[0-9]' and c rlike '[A-Za-z]'", "not c rlike '[^0-9a-f]'", "c rlike '[.][A-Za-z]{2,}$'", f"lower(pre) rlike '{WORDS}'", "pre rlike '[0-9A-Za-z]$'", "post rlike '^[0-9A-Za-z]'", "length(c) >= 32",
)
BITS = len(FEATURES)
#: Features that a kind's rule looks at, and that its candidates therefore go without.
MASK = {"phone": 1 << 0, "secret": 1 << 12}
BLOCK = 64
ROUNDS, RATE, PRECISION = 24, 0.3, 0.9

LUHN = """aggregate(sequence(1, length({d})), 0, (s, i) -> s + if((length({d}) - i) % 2 = 0, cast(substr({d}, i, 1) as int),
  cast(substr({d}, i, 1) as int) * 2 - if(cast(substr({d}, i, 1) as int) > 4, 9, 0))) % 10 = 0"""
DIGITS = "regexp_replace(c, '[^0-9]', '')"
#: Which matches of the base rules hold.
VALID = {
    "email": "true",
    "ip": "forall(split(c, '[.]'), x -> length(ltrim('0', x)) <= 3 and cast(right(concat('0', ltrim('0', x)), 4) as int) <= 255)",
    "card": f"if(length({DIGITS}) between 14 and 19, {LUHN.format(d=DIGITS)}, false)",
    "phone": f"length({DIGITS}) between 10 and 15",
}


def _sums(lengths: str) -> str:
    """Running sums of an array column: blocks are summed up apart, then shifted, so that time stays far below the square of the length."""
    part = f"transform(sequence(0, cast((size({lengths}) - 1) div {BLOCK} as int)), b -> aggregate(slice({lengths}, b * {BLOCK} + 1, {BLOCK}), cast(array() as array<int>), (a, x) -> concat(a, array(x + if(size(a) = 0, 0, a[size(a) - 1])))))"
    shift = "aggregate(parts, cast(array(0) as array<int>), (a, p) -> concat(a, array(a[size(a) - 1] + p[size(p) - 1])))"
    return f"if(size({lengths}) = 0, cast(array() as array<int>), flatten(transform(array({part}), parts -> flatten(transform(array({shift}), at -> flatten(zip_with(parts, slice(at, 1, size(parts)), (p, o) -> transform(p, x -> x + o))))))))"


def _q(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _matches(df: DataFrame, kind: str, rule: str, name: str, tail: str = "") -> DataFrame:
    """A column of all matches of rule, less the characters of tail at their
    ends, array<struct<kind, start, end, c, pre, post>>; offsets are code points."""
    none = "cast(array() as array<string>)"
    df = df.withColumn("_m", F.expr(f"if({NEEDS[kind]}, regexp_extract_all(text, {_q(rule)}, 0), {none})"))
    df = df.withColumn("_p", F.expr(f"if(size(_m) = 0, {none}, split(text, {_q(rule)}, -1))"))
    df = df.withColumn("_l", F.expr("transform(_m, (x, i) -> length(_p[i]) + length(x))"))
    df = df.withColumn("_e", F.expr(_sums("_l")))
    k = KINDS.index(kind)
    c = f"trim(trailing {_q(tail)} from x)" if tail else "x"
    post = f"left(concat(substr(x, length({c}) + 1), _p[i + 1]), 4)" if tail else "left(_p[i + 1], 4)"
    df = df.withColumn(name, F.expr(f"transform(_m, (x, i) -> named_struct('start', _e[i] - length(x), 'kind', {k}, 'end', _e[i] - length(x) + length({c}), 'c', {c}, 'pre', right(_p[i], 16), 'post', {post}))"))
    return df.drop("_m", "_p", "_l", "_e")


def base_spans(docs: DataFrame) -> DataFrame:
    """docs (text not null) with _base: the base spans, by start, then kind."""
    for kind, rule in BASE.items():
        docs = _matches(docs, kind, rule, f"_b_{kind}")
        docs = docs.withColumn(f"_b_{kind}", F.expr(f"transform(filter(_b_{kind}, s -> exists(array(s.c), c -> {VALID[kind]})), s -> named_struct('start', s.start, 'kind', s.kind, 'end', s.end))"))
    parts = [f"_b_{k}" for k in BASE]
    return docs.withColumn("_base", F.expr(f"array_sort(concat({', '.join(parts)}))")).drop(*parts)


#: Whether a strict rule can judge a candidate, and its outcome, both by the candidate alone.
JUDGED = "case s.kind when 0 then contains(s.c, '@') when 1 then true when 2 then not contains(s.c, '.') and s.digits between 14 and 19 when 3 then startswith(s.c, '+') else true end"
OUTCOME = "exists(array(s.c), c -> case s.kind when 0 then c rlike {email} when 1 then not c rlike '([.][0-9]+){{4}}' and {ip} when 2 then {card} when 3 then {phone} else lower(s.pre) rlike {key} end)".format(
    email=_q(r"^[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++$"), ip=VALID["ip"], card=VALID["card"], phone=VALID["phone"], key=_q(r"(?:token|key|secret|passw)[a-z]* ?[=:]? ?[\"']?$")
)


def candidates(docs: DataFrame, judge: bool = False) -> DataFrame:
    """docs with _base and _cand: candidates with their bits; with judge, whether a rule judges them and its outcome."""
    if not judge:
        docs = base_spans(docs)
    for kind, rule in WIDE.items():
        docs = _matches(docs, kind, rule, f"_w_{kind}", TAIL.get(kind, ""))
    parts = [f"_w_{k}" for k in WIDE]
    bits = " | ".join(f"if({f}, {1 << i}, 0)" for i, f in enumerate(FEATURES))
    bits = bits.replace("digits", "s.digits").replace("(c,", "(s.c,").replace("c rlike", "s.c rlike").replace("pre rlike", "s.pre rlike").replace("lower(pre)", "lower(s.pre)").replace("post rlike", "s.post rlike").replace("length(c)", "length(s.c)")
    seen = " ".join(f"when {KINDS.index(k)} then {(1 << BITS) - 1 - m}" for k, m in MASK.items())
    more = f", 'judged', {JUDGED}, 'valid', {OUTCOME}" if judge else ""
    return (
        docs.withColumn("_w", F.expr(f"transform(concat({', '.join(parts)}), s -> named_struct('start', s.start, 'kind', s.kind, 'end', s.end, 'c', s.c, 'pre', s.pre, 'post', s.post, 'digits', length(regexp_replace(s.c, '[^0-9]', ''))))"))
        .withColumn("_cand", F.expr(f"transform(_w, s -> named_struct('start', s.start, 'kind', s.kind, 'end', s.end, 'bits', ({bits}) & case s.kind {seen} else {(1 << BITS) - 1} end{more}))"))
        .drop("_w", *parts)
    )


# the trees: fitted on counts by (kind, bits)


def _fit(cells: list[tuple[int, int, float, float]]) -> list[tuple]:
    """Newton boosting of depth-two trees on (kind, bits, n, positives). A test
    is a bit, or a kind as bit BITS + kind. A tree is (a, no, yes); no and yes
    are (b, leaf if b is 0, leaf if it is 1)."""
    cells = [(b | 1 << (BITS + k), n, y) for k, b, n, y in cells]
    if not cells:
        return []
    tests = [t for t in range(BITS + len(KINDS)) if 0 < sum(c[0] >> t & 1 for c in cells) < len(cells)]
    score, trees = [0.0] * len(cells), []
    for _ in range(ROUNDS):
        g = []
        for (x, n, y), s in zip(cells, score, strict=True):
            p = 1 / (1 + math.exp(-s))
            g.append((x, y - n * p, n * p * (1 - p)))

        def split(rows, g=g):
            """(gain, test, leaf 0, leaf 1) of the best test."""
            total_g, total_h = sum(r[1] for r in rows), sum(r[2] for r in rows)
            best = (0.0, -1, RATE * total_g / (total_h + 1), RATE * total_g / (total_h + 1))
            for t in tests:
                g1 = h1 = 0.0
                for x, a, h in rows:
                    if x >> t & 1:
                        g1, h1 = g1 + a, h1 + h
                g0, h0 = total_g - g1, total_h - h1
                gain = g0 * g0 / (h0 + 1) + g1 * g1 / (h1 + 1) - total_g * total_g / (total_h + 1)
                if gain > best[0] + 1e-9:
                    best = (gain, t, RATE * g0 / (h0 + 1), RATE * g1 / (h1 + 1))
            return best

        def deeper(t):
            no, yes = split([r for r in g if not r[0] >> t & 1]), split([r for r in g if r[0] >> t & 1])
            return no[0] + yes[0], (t, no[1:], yes[1:])

        first = split(g)
        if first[1] < 0:
            break
        tree = deeper(first[1])[1]
        trees.append(tree)
        score = [s + _leaf(tree, x) for (x, _, _), s in zip(cells, score, strict=True)]
    return trees


def _leaf(tree: tuple, x: int) -> float:
    b, no, yes = tree[2] if x >> tree[0] & 1 else tree[1]
    return yes if b >= 0 and x >> b & 1 else no


def _thresholds(cells, trees, precision: float) -> dict[int, float]:
    """For each kind the lowest score that keeps the precision, by a Wilson lower bound at 95 %."""
    out = {}
    for kind in range(len(KINDS)):
        rows = sorted(((sum(_leaf(t, b | 1 << (BITS + kind)) for t in trees), n, y) for k, b, n, y in cells if k == kind), reverse=True)
        n_all = y_all = 0.0
        for i, (s, n, y) in enumerate(rows):
            n_all, y_all = n_all + n, y_all + y
            if i + 1 < len(rows) and rows[i + 1][0] == s:
                continue
            p, z = y_all / n_all, 1.645
            low = (p + z * z / (2 * n_all) - z * math.sqrt(p * (1 - p) / n_all + z * z / (4 * n_all * n_all))) / (1 + z * z / n_all)
            if low >= precision:
                out[kind] = s
    return out


class Model:
    """Trees, and the score from which on a kind's candidates are taken."""

    def __init__(self, trees: list[tuple], thresholds: dict[int, float]) -> None:
        self.trees, self.thresholds = trees, thresholds

    def takes(self, kind: int, bits: int) -> bool:
        return kind in self.thresholds and sum(_leaf(t, bits | 1 << (BITS + kind)) for t in self.trees) >= self.thresholds[kind] - 1e-9

    def sql(self, s: str) -> str:
        """A boolean over the struct s with kind and bits."""
        x = f"({s}.bits | shiftleft(1, {BITS} + {s}.kind))"
        bit = lambda t: f"({x} & {1 << t}) <> 0"
        half = lambda h: f"{h[1]!r}D" if h[0] < 0 else f"if({bit(h[0])}, {h[2]!r}D, {h[1]!r}D)"
        score = " + ".join(f"if({bit(a)}, {half(yes)}, {half(no)})" for a, no, yes in self.trees) or "0D"
        least = " ".join(f"when {k} then {t - 1e-9!r}D" for k, t in self.thresholds.items())
        return f"({score}) >= case {s}.kind {least} else double('infinity') end" if least else "false"


def fit(docs: DataFrame, precision: float = PRECISION, text: str = "text") -> Model:
    """Learn from the candidates of all docs. Where no rule judges any
    candidate, as in an empty table, nothing is taken beyond the base spans.
    Null texts count as empty; equal texts fall into one half."""
    texts = docs.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    c = candidates(texts, judge=True).withColumn("half", F.expr("pmod(xxhash64(text, 2), 2)"))
    rows = (
        c.select("half", F.explode_outer("_cand").alias("s")).where("s.judged")  # explode() would have the planner infer a filter that repeats all of _cand below
        .groupBy("half", "s.kind", "s.bits").agg(F.count("*").alias("n"), F.sum(F.col("s.valid").cast("int")).alias("y"))
        .collect()
    )
    cells = [sorted((r["kind"], r["bits"], float(r["n"]), float(r["y"])) for r in rows if r["half"] == half) for half in (0, 1)]
    trees = _fit(cells[0])
    return Model(trees, _thresholds(cells[1], trees, precision))


def _all_spans(model: Model) -> str:
    """SQL: the base spans and the selected candidates that overlap none of their
    kind, sorted. Candidates that are base spans go first, by hash, so that few are held against all base spans."""
    key = lambda s: f"concat({s}.kind, ':', {s}.start, ':', {s}.end)"
    new = f"array_except(transform(filter(_cand, s -> {model.sql('s')}), s -> {key('s')}), transform(_base, s -> {key('s')}))"
    spans = f"transform(transform({new}, x -> split(x, ':')), x -> named_struct('start', cast(x[1] as int), 'kind', cast(x[0] as int), 'end', cast(x[2] as int)))"
    free = f"filter({spans}, s -> not exists(_base, b -> b.kind = s.kind and b.start < s.end and s.start < b.end))"
    return f"if(size(_cand) = 0, _base, array_sort(concat(_base, {free})))"


def find(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, base, spans) for each row: base spans and all spans, both
    array<struct<start, kind, end>> by start, kind and end, in code points. A
    null text is empty. A selected candidate that overlaps a base span of its
    kind adds nothing, as the base span stays as it is. Spans of different kinds
    may overlap. Equal rows give equal results, texts may be of any length,
    other columns are not read, and an empty table gives an empty one."""
    d = candidates(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")))
    return d.withColumn("_spans", F.expr(_all_spans(model))).select("doc_id", "text", F.col("_base").alias("base"), F.col("_spans").alias("spans"))


def spans_text(spans: str) -> str:
    """kind:start:end, comma-joined, of a span array."""
    names = "array({})".format(", ".join(f"'{k}'" for k in KINDS))
    return f"array_join(transform({spans}, s -> concat({names}[s.kind], ':', cast(s.start as string), ':', cast(s.end as string))), ',')"


def redacted(text: str, spans: str) -> str:
    """text with each stretch covered by spans replaced by its first kind in
    brackets. The text is taken apart into code points once, so time is linear."""
    names = "array({})".format(", ".join(f"'[{k.upper()}]'" for k in KINDS))
    merged = f"""aggregate({spans}, cast(array() as array<struct<start int, kind int, end int>>),
      (a, s) -> if(size(a) > 0 and s.start < a[size(a) - 1].end,
        concat(slice(a, 1, size(a) - 1), array(named_struct('start', a[size(a) - 1].start, 'kind', a[size(a) - 1].kind, 'end', greatest(a[size(a) - 1].end, s.end)))),
        concat(a, array(s))))"""
    pieces = f"""transform(array({merged}), m -> transform(array(regexp_extract_all({text}, '(?s).', 0)), ch -> concat(
      array_join(transform(m, (s, i) -> concat(array_join(slice(ch, if(i = 0, 0, m[i - 1].end) + 1, s.start - if(i = 0, 0, m[i - 1].end)), ''), {names}[s.kind])), ''),
      array_join(slice(ch, m[size(m) - 1].end + 1, size(ch)), '')))[0])[0]"""
    return f"if(size({spans}) = 0, {text}, {pieces})"


def redact(docs: DataFrame, model: Model | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with all spans of text replaced; other columns stay, and names that
    begin with _ do not clash. A null text stays null, an empty one empty. Equal
    rows give equal results; an empty table stays empty."""
    model = model or fit(docs, text=text)
    cols = docs.columns
    d = candidates(docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("d"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")))
    d = d.withColumn("_spans", F.expr(_all_spans(model)))
    clean = F.expr(f"if(d.`{text}` is null, cast(null as string), {redacted('text', '_spans')})")
    return d.withColumn("_clean", clean).select(*[F.col("_clean").alias(c) if c == text else F.col(f"d.`{c}`") for c in cols])
