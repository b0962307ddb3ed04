"""Secrets in whole texts: fixed patterns, and formats learnt from what the patterns find.

The values found by the patterns are labelled credentials. For each kind a prefix tree of its labelled values is
turned into a probabilistic automaton: states are visited breadth first, and a state is merged with an earlier
one when a Hoeffding test finds no difference between how often they end and how often they go on with each
character, they and all states behind them; else it stays a state of its own. That is done twice: first among
states equally far from the start, which pools the counts of the many thin branches, then among all that are left,
where a format of fixed length now has the counts to keep its length and a free one closes into loops.

Every other candidate, a run of 16 or more letters, digits and `+/_=-` with at least one letter and one digit, is
then scored by each automaton: its log-likelihood a character. A candidate is a secret when some kind finds it
about as likely as all but `miss` of its own labelled values, and likelier than it is among candidates in general,
whose character frequencies are counted over all documents. Such spans are added under the kind `format` unless
they touch a span of a pattern, which stay as they are.

The automata are learnt from all distinct values of a kind, counted by Spark; trees grow from their first `TRAINED`
characters. A branch is a state of its own if at least one in `per_kind` of the kind's values comes by (with up to
`per_kind` values every branch is); all thinner ones of a depth are one state, which the merging would make of them too,
since a test of few values tells nothing apart. So all values are in the counts, and at most `per_kind` + 1 states a depth
reach the driver. Where a tree stops a value goes on or not, nobody knows: such a state is like any other and becomes part
of the loop most came by. Values are told apart and scored over their whole length, whatever it is, and what all but `miss`
of them reach is the score at that rank among all. Defined cases: null and empty texts have no spans; positions are code
points, ends exclusive; repeated documents are scanned each for itself; without labelled values nothing is added.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtally.llm.bytescan import release
from fieldtally.llm.shared import ship, texts

# fixed values: the patterns of the three kinds, in the order in which they are listed
PATTERNS = {
    "assign": re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                         re.ASCII),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]{24,}"),
}
KINDS = [*PATTERNS, "format"]
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_LETTER, _DIGIT = re.compile(r"[A-Za-z]"), re.compile(r"[0-9]")
#: Depth of a prefix tree. Longer values are scored by the loops behind it, over all their characters.
TRAINED = 256
_CHARACTERS = 68  # that a value of any kind can have
_ON = ">"  # no character of a value: stands for going on behind a tree
_FETCHED = 10_000  # scores or counts of scores that the driver takes at once
_CACHED = 256  # longer values are scored each time, so that the cache stays small
_HELD = 16_000_000  # characters of found values that a task holds before it sends them on
SPANS = "doc_id bigint, spans array<struct<kind:string,first:int,last:int>>"
_SPAN = pa.struct([("kind", pa.string()), ("first", pa.int32()), ("last", pa.int32())])


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """Kind, start, end and value of everything the patterns find, by start, then in the order of the kinds."""
    out = []
    for m in PATTERNS["assign"].finditer(text):
        if len(m[2]) >= 6:
            out.append(("assign", *m.span(), m[2]))
    out += [("access", *m.span(), m[0]) for m in PATTERNS["access"].finditer(text) if len(m[0]) >= 20]
    out += [("hex", *m.span(), m[0]) for m in PATTERNS["hex"].finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(text: str, taken: list[tuple[str, int, int, str]]) -> Iterator[tuple[int, int, str]]:
    """Start, end and text of every candidate that touches no span in `taken`."""
    for m in CANDIDATE.finditer(text):
        if _DIGIT.search(m[0]) and _LETTER.search(m[0]) and not any(s < m.end() and m.start() < e for _, s, e, _ in taken):
            yield (*m.span(), m[0])


class Automaton:
    """A probabilistic automaton: for each state how many values came by, ended, and went on with each character.

    What a value does behind its first `TRAINED` characters is not counted, nor that it came there."""

    def __init__(self, edges: list[tuple[str | None, int, str, int]], least: int, alpha: float = 0.05):
        """From the `edges` of a tree as ``tree_edges`` counts them, with the same `least`."""
        letters = [(p, d, c, n) for p, d, c, n in edges if c not in ("", _ON)]
        own = sorted({""} | {p + c for p, _, c, n in letters if p is not None and n >= least})
        thin = sorted({d + 1 for p, d, _, n in letters if p is None or n < least})
        state = {p: i for i, p in enumerate(own)}
        pool = {d: len(own) + i for i, d in enumerate(thin)}
        size = len(own) + len(thin)
        self.came, self.ended = [0] * size, [0] * size
        self.next: list[dict[str, int]] = [{} for _ in range(size)]
        self.count: list[dict[str, int]] = [{} for _ in range(size)]
        for p, d, c, n in edges:
            at = pool[d] if p is None else state[p]
            if c == _ON:
                continue
            self.came[at] += n
            if c == "":
                self.ended[at] += n
            else:
                self.count[at][c] = n
                self.next[at][c] = pool[d + 1] if p is None or n < least else state[p + c]
        self._merge(alpha)
        self.letters = max(2, len({c for n in self.next for c in n}))

    def _alike(self, a: int, b: int, bound: float) -> bool:
        """Whether no Hoeffding test tells the states a and b, or any that follow both in step, apart."""
        pairs, seen = [(a, b)], {(a, b)}
        while pairs:
            a, b = pairs.pop()
            na, nb = self.came[a], self.came[b]
            if not na or not nb:
                continue
            limit = bound * (1 / math.sqrt(na) + 1 / math.sqrt(nb))
            if abs(self.ended[a] / na - self.ended[b] / nb) > limit:
                return False
            for c in self.count[a].keys() | self.count[b].keys():
                if abs(self.count[a].get(c, 0) / na - self.count[b].get(c, 0) / nb) > limit:
                    return False
            for c, s in self.next[a].items():
                pair = self._now(s), self._now(self.next[b].get(c, s))
                if c in self.next[b] and pair[0] != pair[1] and pair not in seen:
                    seen.add(pair)
                    pairs.append(pair)
        return True

    def _now(self, state: int) -> int:
        """The state that a state has become part of."""
        while self.part_of[state] != state:
            self.part_of[state] = self.part_of[self.part_of[state]]
            state = self.part_of[state]
        return state

    def _fold(self, a: int, b: int) -> None:
        """Merge b into a, and those that follow both by the same character, so that the automaton stays deterministic."""
        pairs = [(a, b)]
        while pairs:
            a, b = (self._now(s) for s in pairs.pop())
            if a == b:
                continue
            a, b = min(a, b), max(a, b)
            self.part_of[b] = a
            self.came[a] += self.came[b]
            self.ended[a] += self.ended[b]
            for c, n in self.count[b].items():
                self.count[a][c] = self.count[a].get(c, 0) + n
            for c, s in self.next[b].items():
                if c in self.next[a]:
                    pairs.append((self.next[a][c], s))
                else:
                    self.next[a][c] = s

    def _visit(self, bound: float, same_depth: bool) -> None:
        """Breadth first, merge each state with the first earlier one that is like it."""
        kept, depth, border = [0], {0: 0}, [0]
        while border:
            after = []
            for state in border:
                for c in sorted(self.next[self._now(state)]):
                    new, d = self._now(self.next[self._now(state)][c]), depth[state] + 1
                    if new in depth:
                        continue
                    near = [s for s in kept if self._now(s) == s and (depth[s] == d or not same_depth)]
                    near.sort(key=lambda s: (depth[s] != d, -self.came[s], s))
                    same = next((s for s in near if self._alike(s, new, bound)), None)
                    if same is None:
                        depth[new] = d
                        kept.append(new)
                        after.append(new)
                    else:
                        self._fold(same, new)
            # merging may have given kept states new followers
            open_ = [s for s in kept if self._now(s) == s and any(self._now(t) not in depth for t in self.next[s].values())]
            border = sorted(set(after + open_), key=lambda s: (depth[s], s))
        self.states = [s for s in kept if self._now(s) == s]

    def _merge(self, alpha: float) -> None:
        self.part_of = list(range(len(self.came)))
        bound = math.sqrt(0.5 * math.log(2 / alpha))
        self._visit(bound, same_depth=True)
        self._visit(bound, same_depth=False)
        for state in self.states:
            self.next[state] = {c: self._now(s) for c, s in self.next[state].items()}

    def log_likelihood(self, value: str) -> float:
        """Natural logarithm of the smoothed probability of the value."""
        state, total, smooth = 0, 0.0, 0.05
        for at, c in enumerate(value):
            if state is None:  # no value went on like this: all that follows, the end too, is equally likely
                return total - (len(value) - at + 1) * math.log(_CHARACTERS + 1)
            total += math.log((self.count[state].get(c, 0) + smooth) / (self.came[state] + smooth * (self.letters + 1)))
            state = self.next[state].get(c)
        if state is None:
            return total - math.log(_CHARACTERS + 1)
        return total + math.log((self.ended[state] + smooth) / (self.came[state] + smooth * (self.letters + 1)))


class Formats:
    """The automata of all kinds with the least score at which each calls a candidate a secret."""

    def __init__(self, automata: dict[str, Automaton], background: dict[str, int]):
        total = sum(background.values()) + 64
        self.usual = {c: math.log((background.get(c, 0) + 1) / total) for c in map(chr, range(128))}
        self.automata = automata
        self.least: dict[str, float] = {}

    def demand(self, kind: str, reached: float, slack: float = 0.1) -> None:
        """Ask for the score that all but a few of the kind's values have `reached`, less `slack` for chance in few values."""
        self.least[kind] = reached - slack

    def by_kind(self, kind: str, value: str) -> float:
        """Log-likelihood a character, the end counted as one."""
        return self.automata[kind].log_likelihood(value) / (len(value) + 1)

    def secret(self, value: str) -> bool:
        usual = sum(self.usual.get(c, self.usual["~"]) for c in value) / (len(value) + 1)
        return any((score := self.by_kind(k, value)) >= self.least[k] and score > usual for k in self.automata)


def learn(docs: DataFrame, per_kind: int = 2_000, miss: float = 0.01) -> Formats:
    """Formats of the credentials that the patterns find in all documents."""
    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[tuple[str, str]] = Counter()
        held = 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                base = base_spans(text)
                found.update((kind, value) for kind, _, _, value in base)
                held += sum(len(value) for _, _, _, value in base)
                for _, _, value in candidates(text, base):
                    found.update(("", c) for c in value)
                if held > _HELD:
                    yield _counted(found)
                    found.clear()
                    held = 0
            if len(found) > 50_000:
                yield _counted(found)
                found.clear()
                held = 0
        yield _counted(found)
        release()

    counted = (texts(docs).select("text").mapInArrow(values, "kind string, value string, n bigint")
               .groupBy("kind", "value").agg(F.sum("n").alias("n")))
    counted = counted.persist()
    scores = None
    try:
        labelled = counted.where(F.col("kind") != "").select("kind", "value")
        size = {r.kind: r.n for r in labelled.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
        least = {kind: -(-n // per_kind) for kind, n in size.items()}
        edges: dict[str, list[tuple[str | None, int, str, int]]] = {kind: [] for kind in sorted(size)}
        for r in tree_edges(labelled, least).collect() if size else ():
            edges[r.kind].append((r.prefix, r.depth, r.char, r.n))
        # at most one row a character of the candidates' alphabet
        background = {r.value: r.n for r in counted.where(F.col("kind") == "").collect()}
        formats = Formats({kind: Automaton(e, least[kind]) for kind, e in edges.items()}, background)
        scores = _scored(labelled, formats).groupBy("kind", "score").agg(F.count(F.lit(1)).alias("n")).persist()
        for kind, n in size.items():
            formats.demand(kind, _at_rank(scores.where(F.col("kind") == kind).select("score", "n"), int(miss * n)))
    finally:
        counted.unpersist()
        if scores is not None:
            scores.unpersist()
    return formats


def tree_edges(labelled: DataFrame, least: dict[str, int]) -> DataFrame:
    """The edges of the prefix trees of all distinct values, by kind: prefix, its depth, the character that follows (empty
    where values end, `_ON` where they go on behind the tree) and the number of values. Prefixes that fewer than `least`
    values of their kind have are one of each depth, null.

    Values are sorted, so a prefix's values follow one another and a task holds one path of the tree. What it cannot
    know to be complete, the paths of its first and last value, is added up with the other tasks'.
    """
    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[str, str | None, int, str, int]] = []
        pooled: Counter[tuple[str, None, int, str]] = Counter()
        path: list[dict[str, int]] = []  # what follows each prefix of the value at hand, shortest first
        kind, value, first = "", "", 0  # `first`: so much of the value at hand the first value has too

        def close(keep: int, last: bool) -> None:
            while len(path) > keep:
                node, depth = path.pop(), len(path)
                if last or depth <= first or sum(node.values()) >= least[kind]:
                    out.extend((kind, value[:depth], depth, c, n) for c, n in node.items())
                else:
                    pooled.update({(kind, None, depth, c): n for c, n in node.items()})

        for batch in batches:
            for new_kind, new, n in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if new_kind != kind:
                    close(0, last=True)
                    common, first = 0, len(new)
                else:
                    common = next((i for i, (a, b) in enumerate(zip(value, new)) if a != b), min(len(value), len(new)))
                    close(common + 1, last=False)
                    first = min(first, common)
                kind, value = new_kind, new
                steps = [*value[:TRAINED], "" if len(value) <= TRAINED else _ON]
                path.extend({} for _ in range(len(steps) - len(path)))
                for node, c in zip(path, steps):
                    node[c] = node.get(c, 0) + n
                if len(out) > _FETCHED:
                    yield _edges(out)
                    out.clear()
        close(0, last=True)
        yield _edges([*out, *((*key, n) for key, n in pooled.items())])
        release()

    # one character more than a tree has tells that a value goes on
    heads = labelled.groupBy("kind", F.substring("value", 1, TRAINED + 1).alias("head")).agg(F.count(F.lit(1)).alias("n"))
    found = (heads.repartitionByRange("kind", "head").sortWithinPartitions("kind", "head")
             .mapInArrow(edges, "kind string, prefix string, depth int, char string, n bigint")
             .groupBy("kind", "prefix", "depth", "char").agg(F.sum("n").alias("n")))
    few = F.col("came") < F.create_map(*[F.lit(x) for pair in least.items() for x in pair])[F.col("kind")]
    nodes = (found.groupBy("kind", "prefix", "depth")  # at most a row a character each
             .agg(F.sum("n").alias("came"), F.collect_list(F.struct("char", "n")).alias("edges"))
             .withColumn("prefix", F.when(~few, F.col("prefix"))))
    return (nodes.select("kind", "prefix", "depth", F.inline("edges"))
            .groupBy("kind", "prefix", "depth", "char").agg(F.sum("n").alias("n")))


def _edges(rows: list[tuple[str, str | None, int, str, int]]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.int32(), pa.string(), pa.int64()]
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["kind", "prefix", "depth", "char", "n"])


def _at_rank(scores: DataFrame, rank: int) -> float:
    """The score at a rank, from 0 for the lowest, among scores that occur n times each. Counts by interval narrow it
    down until the scores left are few."""
    while True:
        ends = scores.agg(F.min("score").alias("low"), F.max("score").alias("high"), F.count(F.lit(1)).alias("different")).first()
        if ends.different <= _FETCHED:
            for r in sorted(scores.collect()):
                if rank < r.n:
                    return r.score
                rank -= r.n
        interval = F.floor((F.col("score") - ends.low) / (ends.high - ends.low) * _FETCHED)
        for here, n in sorted(map(tuple, scores.groupBy(interval.alias("here")).agg(F.sum("n").alias("n")).collect())):
            if rank < n:
                break
            rank -= n
        scores = scores.where(interval == here)


def _scored(found: DataFrame, formats: Formats) -> DataFrame:
    """kind and score of labelled values, over their whole length."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, values = (batch.column(i).to_pylist() for i in range(2))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([formats.by_kind(k, v) for k, v in zip(kinds, values)], pa.float64())],
                ["kind", "score"])

    return found.select("kind", "value").mapInArrow(score, "kind string, score double")


def _counted(found: Counter[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in found], pa.string()), pa.array([v for _, v in found], pa.string()),
         pa.array(list(found.values()), pa.int64())], ["kind", "value", "n"])


def spans_of(text: str, formats: Formats) -> list[tuple[str, int, int]]:
    """All spans of one text, by start, then in the order of the kinds."""
    base = base_spans(text)
    more = [("format", s, e) for s, e, value in candidates(text, base) if _secret(formats)(value)]
    return sorted([s[:3] for s in base] + more, key=lambda s: (s[1], KINDS.index(s[0])))


@functools.lru_cache(maxsize=1)
def _secret(formats: Formats):
    cached = functools.lru_cache(maxsize=100_000)(formats.secret)
    return lambda value: cached(value) if len(value) <= _CACHED else formats.secret(value)


def find(docs: DataFrame, formats: Formats) -> DataFrame:
    """For every document: doc_id and its spans (kind, first, last)."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[{"kind": k, "first": s, "last": e} for k, s, e in spans_of(text, formats)]
                     for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(_SPAN))], ["doc_id", "spans"])
        release()

    return texts(docs).mapInArrow(scan, SPANS)


def redact(docs: DataFrame, formats: Formats, mark: str = "[SECRET]") -> DataFrame:
    """The documents with every span of their texts replaced by a mark and n_chars, if there is one, brought up to date.

    Overlapping spans become one mark. Other columns, null texts and texts without spans stay as they are.
    """
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            out = []
            for text in batch.column(at).to_pylist():
                done, parts, last = 0, [], -1
                for _, s, e in spans_of(text, formats) if text else ():
                    if s >= last:
                        parts += [text[done:s], mark]
                    done = last = max(e, last)
                out.append(text if not parts else "".join(parts) + text[done:])
            yield batch.set_column(at, "text", pa.array(out, batch.schema.field(at).type))
        release()

    ship(docs.sparkSession)
    cleaned = docs.mapInArrow(clean, docs.schema)
    if "n_chars" not in docs.columns:
        return cleaned
    kind = docs.schema["n_chars"].dataType
    return cleaned.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(kind))


def digests(found: DataFrame) -> DataFrame:
    """The contract's columns: spans by pattern, the digest of the patterns' spans, and all spans as text."""
    def listed(spans: Column) -> Column:
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["first"], s["last"])))

    def n(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "format")
    return found.select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(listed(base), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"))
