"""Personal data by patterns and a skip-chain conditional random field.

**Base spans** per kind (email, ip, card, phone) are fixed patterns, leftmost
and non-overlapping, with a check after each (IP parts up to 255; Luhn for
cards; digit counts).

**The field** labels candidate tokens (number groups and words with ``@``) with
a kind or as other; all other words are observed as other, so they need no
node.  A node has features of its shape and of the word before it.  Neighbouring candidates are joined by
chain edges; candidates with the same key, however far apart, by skip edges whose potential is shared and favours
equal labels.  Equal keys have: numbers of the same four small parts (whatever stands between them), else of the same
last seven digits; addresses of the same local part and first label of the domain, in any case.
All repeats of a key are joined to one hub, so edges grow with the tokens and not
with their square, and any two repeats are two steps apart, wherever they stand.  A hub is a label
to be inferred like any other, without evidence of its own.  Tokens that are written alike are one piece of evidence
for it, not many: each sends its message with the weight 1 / (their number), so that
fifty short forms do not outvote the one full form.
Candidates under a base span are observed.  Loopy
sum-product message passing runs over each document until the messages settle
(the limit of rounds grows with the nodes).  A candidate whose belief in a kind reaches ``CERTAIN`` and
that overlaps no base span is an added span of that kind: a number written
without its country code, say, in a document that spells it out elsewhere.

The weights are fitted by pseudo-likelihood on the same graph (each label given its features, its chain
neighbours' labels and its hub's) over at most ``FIT_DOCS`` documents.  Labels are the base ones; a token that shares
its key with a base span takes that span's.  As texts seldom hold such tokens, each learnt text
with base spans gets two more at hashed places: one span in another form, and a token of
that form with other digits or letters, which is other.  The decisive features are hidden
at random, so that the rest of a token's shape and its neighbours carry weight as well.

A null text counts as empty; texts without a digit or ``@`` have no spans.  Spans are in code points, end
exclusive, of the whole text.  Null and repeated doc_ids are kept, one row per input
row.  Other columns are ignored.  With no candidates to learn from, no spans are
added.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockhand.llm.common import settle, text_batches

KINDS = ("email", "ip", "card", "phone")
FIT_DOCS = 2000
FIT_NODES = 20_000
ROUNDS = 1000      # and ROUNDS_PER_NODE more for each node: a limit for messages that never settle
ROUNDS_PER_NODE = 4
SETTLED = 1e-6     # a smaller change of a message is none
CERTAIN = 0.97
CONSISTENCY = 4.0  # log potential that skip edges give to equal labels, besides the fitted one
OBSERVED = 12.0    # log potential of a base span's kind at the candidates it covers
HIDE = 0.3
STEPS, RATE, DECAY = 300, 0.05, 1e-4  # of the fit
CHAIN_REACH = 40   # characters between neighbouring candidates
_NEAR_WORDS = 64   # hashed buckets of the word before

# The base patterns.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

# What is run: the same matches, in time linear in the text.  A number or local
# part that fails from its first character fails from every later one.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_PATTERNS = (("ip", re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")), ("card", re.compile(CARD)), ("phone", re.compile(PHONE)))

_ANY = re.compile(r"[0-9@]")
_SPACE = re.compile(r"\s")
_NUMBER = re.compile(r"\+?\(?[0-9](?:[\x20().-]{0,2}[0-9])*")
_GROUPS = re.compile(r"[0-9]+")
_OTHER = len(KINDS)
_BLOCK = 4096  # candidates whose features are held at once


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        x = x if k % 2 == 0 else 2 * x - 9 * (x > 4)
        total += x
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _valid(kind: str, text: str) -> bool:
    if kind == "email":
        return True
    if kind == "ip":
        return all(_small(p) for p in text.split("."))
    digits = _digits(text)
    return 12 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 9 <= len(digits) <= 15


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        lo = at
        while lo > done and text[lo - 1] in _LOCAL:
            lo -= 1
        found = _DOMAIN.match(text, at + 1) if lo < at else None
        if found:
            yield lo, found.end()
        done = found.end() if found else at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns, by start, then kind as listed."""
    out = [(s, e, "email") for s, e in _emails(text)]
    for kind, pattern in _PATTERNS:
        out += [(m.start(), m.end(), kind) for m in pattern.finditer(text) if _valid(kind, m[0])]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def _at_words(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        lo = at
        while lo > done and not text[lo - 1].isspace():
            lo -= 1
        end = _SPACE.search(text, at)
        done = end.start() if end else len(text)
        hi = done
        while hi > at + 1 and text[hi - 1] in ".,;:!?":
            hi -= 1
        yield lo, hi
        at = text.find("@", done)


def candidates(text: str) -> list[tuple[int, int]]:
    """Words with ``@`` and number groups outside them, in order."""
    if not _ANY.search(text):
        return []
    words = list(_at_words(text))
    starts = [w[0] for w in words]

    def outside(lo: int, hi: int) -> bool:
        k = bisect_left(starts, hi)
        return not k or words[k - 1][1] <= lo

    return sorted(words + [m.span() for m in _NUMBER.finditer(text) if outside(*m.span())])


class _Cover:
    """The union of spans, for asking whether a span meets any."""

    def __init__(self, spans):
        self.starts, self.ends = [], []
        for start, end, _ in spans:
            if self.ends and start <= self.ends[-1]:
                self.ends[-1] = max(end, self.ends[-1])
            else:
                self.starts.append(start)
                self.ends.append(end)

    def meets(self, start: int, end: int) -> bool:
        k = bisect_left(self.starts, end)
        return k > 0 and self.ends[k - 1] > start


FEATURES = ("bias", "at", "dotted_at", "four_groups", "small_groups", "luhn", "plus", "paren", "hyphen", "space", "dot",
            "digits_1_4", "digits_5_6", "digits_7_8", "digits_9_11", "digits_12_15", "digits_16_19", "digits_more", "letters")
_DECISIVE = [FEATURES.index(f) for f in ("dotted_at", "small_groups", "luhn", "plus")]
_WIDTH = len(FEATURES) + _NEAR_WORDS


def _node(text: str, start: int, end: int) -> np.ndarray:
    token, digits = text[start:end], _digits(text[start:end])
    n, groups = len(digits), text[start:end].split(".")
    four = len(groups) == 4 and all(g.isascii() and g.isdigit() for g in groups)
    x = np.zeros(_WIDTH)
    x[: len(FEATURES)] = (
        1, "@" in token, "@" in token and "." in token.rpartition("@")[2], four, four and all(map(_small, groups)),
        n >= 12 and luhn(digits), token[0] == "+", "(" in token, "-" in token, " " in token, "." in token,
        n <= 4, 5 <= n <= 6, 7 <= n <= 8, 9 <= n <= 11, 12 <= n <= 15, 16 <= n <= 19, n > 19, any(c.isalpha() for c in token))
    before = text[max(0, start - 24): start].split()
    if before:
        word = before[-1].lower().strip(".,;:()").encode()
        x[len(FEATURES) + hashlib.md5(word).digest()[0] % _NEAR_WORDS] = 0.5
    return x


def _key(token: str) -> str:
    if "@" in token:
        local, _, domain = token.lower().strip(".,;:<>()\"'").partition("@")
        return f"{local}@{domain.partition('.')[0]}"
    groups = _GROUPS.findall(token)
    if len(groups) == 4 and all(map(_small, groups)):
        return ".".join(g.lstrip("0") or "0" for g in groups)
    digits = "".join(groups)
    return digits[-7:] if len(digits) >= 7 else ""


def graph(text: str) -> tuple[list[tuple[int, int]], list[tuple[int, int, int]], list[list[int]]]:
    """Nodes (spans), chain edges (i, j, 0) and hubs (the nodes of each key that several share)."""
    spans = candidates(text)
    chain = [(j - 1, j, 0) for j in range(1, len(spans)) if spans[j][0] - spans[j - 1][1] <= CHAIN_REACH]
    members: dict[str, list[int]] = defaultdict(list)
    for j, (start, end) in enumerate(spans):
        key = _key(text[start:end])
        if key:
            members[key].append(j)
    return spans, chain, [nodes for nodes in members.values() if len(nodes) > 1]


def node_features(text: str, spans: list[tuple[int, int]]) -> np.ndarray:
    return np.array([_node(text, *s) for s in spans]) if spans else np.zeros((0, _WIDTH))


def _truth(spans: list[tuple[int, int]], base: list[tuple[int, int, str]]) -> list[int]:
    """Base label of each candidate: the kind of a base span that meets it."""
    covers = [_Cover([s for s in base if s[2] == kind]) for kind in KINDS]
    return [next((k for k, c in enumerate(covers) if c.meets(*span)), _OTHER) for span in spans]


def _entities(truth: list[int], hubs: list[list[int]]) -> tuple[list[int], list[int]]:
    """Labels of the nodes, where a token of a key takes its base spans' kind (the most frequent), and of the hubs."""
    labels, of_hub = list(truth), []
    for nodes in hubs:
        kinds = [truth[i] for i in nodes if truth[i] != _OTHER]
        of_hub.append(max(sorted(set(kinds)), key=kinds.count) if kinds else _OTHER)
        for i in nodes:
            labels[i] = of_hub[-1] if truth[i] == _OTHER else truth[i]
    return labels, of_hub


def beliefs(unary: np.ndarray, edges: list[tuple[int, int, int]], pair: np.ndarray, weight: np.ndarray | None = None) -> np.ndarray:
    """Marginals by loopy sum-product; ``unary`` nodes x labels and ``pair`` type x labels x labels are log potentials.

    ``weight`` (one per edge, else 1) scales the log messages that go from an edge's first node to its second."""
    if not edges:
        x = np.exp(unary - unary.max(1, keepdims=True))
        return x / x.sum(1, keepdims=True)
    i, j, kind = np.array(edges).T
    src, dst = np.concatenate([i, j]), np.concatenate([j, i])
    potential = np.exp(np.concatenate([pair[kind], pair[kind].transpose(0, 2, 1)]))
    back = np.concatenate([np.arange(len(i)) + len(i), np.arange(len(i))])
    scale = np.concatenate([np.ones(len(i)) if weight is None else weight, np.ones(len(i))])[:, None]
    message, total = np.zeros((len(src), unary.shape[1])), unary.copy()
    at = np.arange(len(src))  # messages that may still change
    for _ in range(ROUNDS + ROUNDS_PER_NODE * len(unary)):
        out = total[src[at]] - message[back[at]]
        out = np.exp(out - out.max(1, keepdims=True))
        new = np.log(np.einsum("el,elm->em", out, potential[at]) + 1e-300) * scale[at]
        new -= np.logaddexp.reduce(new, axis=1, keepdims=True)
        change = new - message[at]
        moved = np.abs(change).max(1) > SETTLED
        change[moved] *= 0.5
        message[at] += change
        np.add.at(total, dst[at], change)
        if not moved.any():
            break
        touched, live = np.zeros(len(unary), bool), np.zeros(len(src), bool)
        touched[dst[at[moved]]] = live[at[moved]] = True
        at = np.flatnonzero(live | touched[src])
    total = unary.copy()
    np.add.at(total, dst, message)
    x = np.exp(total - total.max(1, keepdims=True))
    return x / x.sum(1, keepdims=True)


def hub_edges(tokens: list[str], hubs: list[list[int]]) -> tuple[list[tuple[int, int, int]], list[float]]:
    """Skip edges (node, hub, 1), hubs numbered after the nodes, and the weight of the message to the hub."""
    edges, weights = [], []
    for h, nodes in enumerate(hubs):
        alike = Counter(tokens[i] for i in nodes)
        edges += [(i, len(tokens) + h, 1) for i in nodes]
        weights += [1 / alike[tokens[i]] for i in nodes]
    return edges, weights


def fit(features: np.ndarray, neighbours: np.ndarray, labels: np.ndarray, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Pseudo-likelihood fit: log potentials of features (labels x width) and of edges (type x label x label).

    ``neighbours`` has, per node, type and label, the count of neighbours so labelled.
    """
    k, rng = _OTHER + 1, np.random.RandomState(seed)
    weights, pair = np.zeros((k, features.shape[1])), np.zeros((2, k, k))
    hidden = features.copy()
    for column in _DECISIVE:
        hidden[rng.rand(len(hidden)) < HIDE, column] = 0
    one, sums = np.eye(k)[labels], np.minimum(neighbours, 3)
    # Adam: nodes with a hub are few, so their gradients are small and must not learn more slowly for it
    slope, size = [np.zeros_like(weights), np.zeros_like(pair)], [np.zeros_like(weights), np.zeros_like(pair)]
    for step in range(1, STEPS + 1):
        logits = hidden @ weights.T + np.einsum("ntl,tlm->nm", sums, pair)
        p = np.exp(logits - logits.max(1, keepdims=True))
        gap = one - p / p.sum(1, keepdims=True)
        grad = np.einsum("ntl,nm->tlm", sums, gap) / len(labels)
        for k, (x, g) in enumerate(((weights, gap.T @ hidden / len(labels)), (pair, (grad + grad.transpose(0, 2, 1)) / 2))):
            g = g - DECAY * x
            slope[k] = 0.9 * slope[k] + 0.1 * g
            size[k] = 0.99 * size[k] + 0.01 * g * g
            x += RATE * (slope[k] / (1 - 0.9 ** step)) / (np.sqrt(size[k] / (1 - 0.99 ** step)) + 1e-8)
    return weights, pair


_NODES = "features binary, neighbours binary, label int"


def _other_form(token: str, kind: str, rng: random.Random) -> str:
    """A base span as people shorten or regroup it, so that the patterns do not match."""
    if kind == "email":
        local, _, domain = token.partition("@")
        return f"{local}@{domain.partition('.')[0]}"
    groups = _GROUPS.findall(token)
    digits = "".join(groups)
    if kind == "ip":
        return rng.choice("- ").join(groups)
    if kind == "card":
        return ".".join(digits[k:k + 4] for k in range(0, len(digits), 4))
    parts = [x for x in (digits[-10:-7], digits[-7:-4], digits[-4:]) if x]
    return rng.choice(("", "0")) + rng.choice("- .").join(parts)


def _unlike(token: str, rng: random.Random) -> str:
    """A token of the same form with other digits, or other letters before its ``@``."""
    local = token.partition("@")[0]
    if len(local) < len(token):
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") if c.isalpha() else c for c in local) + token[len(local):]
    return "".join(rng.choice("0123456789") if "0" <= c <= "9" else c for c in token)


def planted(text: str) -> str:
    """``text`` with one of its base spans in another form, and a token of that form that names nobody."""
    base = base_spans(text)
    if not base:
        return text
    rng = random.Random(hashlib.md5(text.encode("utf-8", "surrogatepass")).digest())
    start, end, kind = rng.choice(base)
    form, covered = _other_form(text[start:end], kind, rng), _Cover(base)
    places = []
    for token in (form, _unlike(form, rng)):
        at = text.find(" ", rng.randrange(len(text)))
        places.append((len(text) if at < 0 or covered.meets(at, at + 1) else at, token))
    for at, token in sorted(places, reverse=True):
        text = f"{text[:at]} {token}{text[at:]}"
    return text


def _training(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for text in batch.column(0):
            text = planted(text.as_py())
            spans, chain, hubs = graph(text)
            labels, of_hub = _entities(_truth(spans, base_spans(text)), hubs)
            near = np.zeros((len(spans), 2, _OTHER + 1))
            for i, j, t in chain:
                near[i, t, labels[j]] += 1
                near[j, t, labels[i]] += 1
            for nodes, label in zip(hubs, of_hub, strict=True):
                near[nodes, 1, label] = 1
            for lo in range(0, len(spans), _BLOCK):
                part = slice(lo, lo + _BLOCK)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x.tobytes() for x in node_features(text, spans[part])], pa.binary()),
                     pa.array([x.tobytes() for x in near[part]], pa.binary()), pa.array(labels[part], pa.int32())],
                    names=["features", "neighbours", "label"])


def fit_field(docs: DataFrame, most_docs: int = FIT_DOCS, most_nodes: int = FIT_NODES) -> tuple[np.ndarray, np.ndarray] | None:
    """Weights from at most ``most_docs`` documents with candidates (the first by
    a hash of doc_id) and at most ``most_nodes`` of their candidates."""
    known = docs.where(F.col("text").rlike("[0-9@]")).select("text", F.xxhash64("doc_id", "text").alias("h"))
    hashes = settle(known.select("h").distinct())
    # hashes below the bound are about twice the documents wanted, whatever the corpus holds; only they are ordered
    share = min(1.0, 2.0 * most_docs / max(1, hashes.count()))
    bound = min((1 << 63) - 1, -(1 << 63) + int(share * (1 << 64)))
    last = hashes.where(F.col("h") <= bound).orderBy("h").limit(most_docs).agg(F.max("h")).first()[0]
    if last is None:
        last = hashes.agg(F.max("h")).first()[0]
    # texts stay in the tasks that read them, but for one row of each hash
    some = known.where(F.col("h") <= F.lit(last)).groupBy("h").agg(F.first("text").alias("text"))
    nodes = some.select("text").mapInArrow(_training, _NODES).orderBy(F.xxhash64("features", "neighbours")).limit(most_nodes).collect()
    if not nodes:
        return None
    features = np.array([np.frombuffer(bytes(r["features"])) for r in nodes])
    near = np.array([np.frombuffer(bytes(r["neighbours"])).reshape(2, _OTHER + 1) for r in nodes])
    return fit(features, near, np.array([r["label"] for r in nodes]))


def added_spans(text: str, base: list[tuple[int, int, str]], field) -> list[tuple[int, int, str]]:
    """Spans that the field adds to the base ones."""
    if field is None:
        return []
    spans, chain, hubs = graph(text)
    if not spans:
        return []
    weights, pair = field
    unary = np.concatenate([node_features(text, spans[lo:lo + _BLOCK]) @ weights.T for lo in range(0, len(spans), _BLOCK)])
    truth = np.array(_truth(spans, base))
    seen = np.flatnonzero(truth != _OTHER)
    unary[seen, truth[seen]] += OBSERVED
    skip, to_hub = hub_edges([text[s:e] for s, e in spans], hubs)
    belief = beliefs(np.concatenate([unary, np.zeros((len(hubs), _OTHER + 1))]), chain + skip,
                     pair + np.array([0, CONSISTENCY])[:, None, None] * np.eye(_OTHER + 1),
                     np.array([1.0] * len(chain) + to_hub))[: len(spans)]
    covered = _Cover(base)
    return [(*span, KINDS[kind]) for span, kind, p in zip(spans, belief.argmax(1), belief.max(1), strict=True)
            if kind != _OTHER and p >= CERTAIN and not covered.meets(*span)]


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


_FOUND = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long"


def find_pii(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_spans), one row per row of ``docs``.

    The first four counts are of base spans; ``spans`` has the added ones too, ``n_spans`` counts all."""
    shared = docs.sparkSession.sparkContext.broadcast(fit_field(docs.select("doc_id", "text").where("text is not null")))

    def run(batches):
        for batch in batches:
            rows: dict[str, list] = defaultdict(list)
            for text in batch.column(1):
                text = text.as_py() or ""
                base = base_spans(text) if _ANY.search(text) else []
                extra = added_spans(text, base, shared.value) if _ANY.search(text) else []
                for kind in KINDS:
                    rows[kind].append(sum(s[2] == kind for s in base))
                rows["sha"].append(hashlib.sha256(_joined(base).encode()).hexdigest())
                rows["all"].append(len(base) + len(extra))
                rows["spans"].append(_joined(sorted(base + extra, key=lambda s: (s[0], KINDS.index(s[2])))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(rows[k], pa.int64()) for k in KINDS), pa.array(rows["sha"], pa.string()),
                 pa.array(rows["spans"], pa.string()), pa.array(rows["all"], pa.int64())],
                names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_spans"])

    return text_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _FOUND)


def mask(text: str, spans: str) -> str:
    """``text`` with each span (as ``find_pii`` returns them) replaced by its kind in brackets."""
    out, at = [], 0
    for kind, start, end in sorted(((k, int(s), int(e)) for k, s, e in (x.split(":") for x in spans.split(",") if x)), key=lambda s: s[1]):
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])
