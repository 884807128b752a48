"""Secret scans: fixed patterns, and a linear-chain conditional random field that adds to them."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessella.llm.common import arrow, arrow_schema, batch_of, carried, hash_sample, slices, table, utf8
from tessella.llm.words import BASE, LOWERED, mixed, powers

ASSIGN = re.compile(rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS, HEX = re.compile(rb"AKIA[A-Z0-9]{16,}"), re.compile(rb"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "crf")
O, B, I = range(3)

TOKEN = np.zeros(256, bool)
TOKEN[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")] = True
LOWER_HEX, HEX_RUN = np.zeros(256, bool), 24
LOWER_HEX[list(b"0123456789abcdef")] = True
DIGIT, UPPER = np.zeros(256, bool), np.zeros(256, bool)
DIGIT[48:58] = True
UPPER[65:91] = True
CREDENTIAL = re.compile(rb"pass|pwd|secret|token|key|cred|auth", re.IGNORECASE)
#: Number of values of each feature of a token; those of words are hashed.
WORD = 1 << 14
VALUES = {"bias": 1, "len": 24, "digits": 11, "upper": 5, "lower": 5, "turns": 7, "entropy": 16, "hex": 2, "numeric": 2, "mixed": 2, "blend": 2, "long": 2, "head": 2, "equals": 2, "mark": 5, "quote": 2, "closed": 2, "at": 2, "far": 2, "near": 2, "own": 2, "file.long": 6, "file.size": 6, "file.dense": 2, "before": WORD, "before.2": WORD, "after": WORD}
OFFSET = dict(zip(VALUES, np.cumsum([0, *VALUES.values()]).tolist(), strict=False))
#: Tokens whose features are made at once, and tokens of a piece to learn from.
BLOCK, PIECE = 1 << 16, 32


def base_spans(raw: bytes) -> list[tuple[int, int, int]]:
    """(start, end, kind) in bytes."""
    found = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(raw) if m.end(1) - m.start(1) >= 6]
    found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(raw)]
    return found + [(m.start(), m.end(), 2) for m in HEX.finditer(raw)]


def runs(flags: np.ndarray, bounds: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the runs of at least ``least`` flags that do not cross a bound."""
    turn = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).view(np.int8)))
    first, end = turn[::2], turn[1::2]
    cut = bounds[1:-1]
    cut = cut[(cut > 0) & (cut < len(flags))]
    cut = cut[flags[cut] & flags[cut - 1]] if len(cut) else cut
    first, end = np.sort(np.concatenate([first, np.unique(cut)])), np.sort(np.concatenate([end, np.unique(cut)]))
    keep = end - first >= least
    return first[keep], end[keep]


def candidates(buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All tokens: each may be tagged B or I, whatever its length and letters."""
    return runs(TOKEN[buf], bounds, 1)


def _sums(flags: np.ndarray) -> np.ndarray:
    out = np.zeros(len(flags) + 1, np.int32)
    np.cumsum(flags, out=out[1:])
    return out


def _hashes(buf: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A value from 1 of each token in lower case."""
    up, down = powers(BASE, len(buf))
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(LOWERED[buf] * up[: len(buf)], out=total[1:])
    return (mixed((total[end] - total[first]) * down[first]) % np.uint64(WORD - 1)).astype(np.int32) + 1


def _block(buf: np.ndarray, bounds: np.ndarray, first: np.ndarray, end: np.ndarray, owner: np.ndarray, file: list[np.ndarray], words: list[np.ndarray]) -> np.ndarray:
    n = end - first
    digit, upper = DIGIT[buf], UPPER[buf]
    of = lambda flags: (sums := _sums(flags))[end] - sums[first]
    digits, uppers, lowers = of(digit), of(upper), of((buf >= 97) & (buf <= 122))
    turn = _sums(np.concatenate([[False], digit[1:] != digit[:-1]]))
    turns = turn[end] - turn[first + 1]
    entropy = np.zeros(len(n), np.int64)
    some = np.flatnonzero((n >= 6) & (n <= 4096) & ((n >= 12) | (lowers < n - 1)))  # short words of small letters have the value 0
    for lo in range(0, len(some), 4096):
        part = some[lo : lo + 4096]
        at = np.repeat(np.arange(len(part)), n[part])
        where = np.arange(len(at)) - np.repeat(np.cumsum(n[part]) - n[part], n[part]) + np.repeat(first[part], n[part])
        count = np.minimum(np.bincount(at * 128 + buf[where], minlength=len(part) * 128), len(LOGS) - 1).reshape(-1, 128)
        entropy[part] = 1 + (2 * (np.log2(n[part]) - LOGS[count].sum(1) / n[part])).astype(np.int64)
    low, high = bounds[owner], bounds[owner + 1]
    # The nearest byte before that is neither blank nor quote.
    solid = np.where((buf != 32) & (buf != 34) & (buf != 39), np.arange(1, len(buf) + 1), 0)
    np.maximum.accumulate(solid, out=solid)
    at = np.where(first > 0, solid[np.maximum(first - 1, 0)], 0)
    mark = np.where(at > np.maximum(low, first - 40), MARK[buf[np.maximum(at - 1, 0)]], 0)
    before = np.where(first > low, buf[np.maximum(first - 1, 0)], 0)
    after = np.where(end < high, buf[np.minimum(end, len(buf) - 1)], 0)
    last = np.concatenate([[-(1 << 30)], end[:-1]])
    far = first - np.where(last >= low, last, -(1 << 30)) > 3
    named = np.zeros(len(buf), bool)
    named[[m.start() for m in CREDENTIAL.finditer(buf.tobytes())]] = True
    named = _sums(named)
    near, own = named[first] > named[np.maximum(low, first - 24)], named[end] > named[first]
    columns = [
        np.zeros(len(n)), np.where(n < 16, n, np.minimum(14 + n // 8, 23)), 10 * digits // n, 4 * uppers // n, 4 * lowers // n, np.minimum(10 * turns // n, 6), np.minimum(entropy, 15), of(LOWER_HEX[buf]) == n, digits == n, (digits > 0) & (uppers > 0) & (lowers > 0), (digits > 0) & (uppers + lowers > 0), n >= 12,
        (n >= 4) & (_sums(upper)[np.minimum(first + 4, len(buf))] - _sums(upper)[first] == 4), of(buf == 61) > 0, mark, (before == 34) | (before == 39), (after == 34) | (after == 39), (after == 64) | (after == 46), far, near, own, *file, *words,
    ]
    return np.stack([c.astype(np.uint16) + np.uint16(o) for c, o in zip(columns, OFFSET.values(), strict=True)], 1)


#: x * log2(x) of a character's count in a token.
LOGS = np.arange(4097) * np.log2(np.maximum(np.arange(4097), 1))
MARK = np.zeros(256, np.int64)
MARK[list(b":=(|")] = [1, 2, 3, 4]


def columns(buf: np.ndarray, bounds: np.ndarray, first: np.ndarray, end: np.ndarray) -> Iterator[np.ndarray]:
    """Features of all tokens of many texts, a block at a time: a token's shape, the words and marks beside it, and those of the whole file."""
    owner = np.searchsorted(bounds, first, "right") - 1
    size = np.diff(bounds)
    long = np.zeros(len(size), np.int64)
    heavy = np.zeros(len(size), np.int64)
    hashes = np.zeros(len(first) + 4, np.int32)
    for lo in range(0, len(first), BLOCK):
        a, b = first[lo : lo + BLOCK], end[lo : lo + BLOCK]
        at, part = a[0], buf[a[0] : b[-1]]
        hashes[2 + lo : 2 + lo + len(a)] = _hashes(part, a - at, b - at)
        digits = _sums(DIGIT[part])
        shaped = (b - a >= 12) & (digits[b - at] > digits[a - at])
        long += np.bincount(owner[lo : lo + BLOCK][shaped], minlength=len(size))
        heavy += np.bincount(owner[lo : lo + BLOCK][shaped], (b - a)[shaped], len(size)).astype(np.int64)
    log = np.ceil(np.log2(np.maximum(size, 1) + 0.5)).astype(np.int64)
    wide = np.concatenate([[-1, -1], owner, [-1, -1]])
    word = lambda by: np.where(wide[2 + by : 2 + by + len(owner)] == owner, hashes[2 + by : 2 + by + len(owner)], 0)
    whole = [np.minimum(long, 5)[owner], (np.minimum(log, 20) // 4)[owner], (100 * heavy > 5 * size)[owner], word(-1), word(-2), word(1)]
    for lo in range(0, len(first), BLOCK):
        a, b, who = first[lo : lo + BLOCK], end[lo : lo + BLOCK], owner[lo : lo + BLOCK]
        at, to = max(0, int(a[0]) - 64), min(len(buf), int(b[-1]) + 1)
        edges = np.clip(bounds - at, 0, to - at)
        parts = [x[lo : lo + BLOCK] for x in whole]
        yield _block(buf[at:to], edges, a - at, b - at, who, parts[:3], parts[3:])


def features(raw: bytes, tokens: list[tuple[int, int]]) -> np.ndarray:
    """Features of the tokens of one text, a row each."""
    first, end = np.array(tokens, np.int64).reshape(-1, 2).T
    return np.concatenate([np.zeros((0, len(VALUES)), np.uint16), *columns(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), first, end)])


class Field:
    """Emission weights by feature and transitions; both ends of a text touch O."""

    def __init__(self):
        self.emit, self.move = np.zeros((sum(VALUES.values()), 3)), np.zeros((3, 3))

    def scores(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros((3, len(rows)))
        for column in np.ascontiguousarray(rows.T):
            for tag, weights in enumerate(np.ascontiguousarray(self.emit.T)):
                out[tag] += weights[column]
        return np.ascontiguousarray(out.T)

    def transitions(self) -> np.ndarray:
        move = self.move.copy()
        move[O, I] = -1e9
        return move

    def viterbi(self, scores: np.ndarray) -> list[int]:
        move = self.transitions()
        best, back = move[O] + scores[0], []
        for row in scores[1:]:
            total = best[:, None] + move
            back.append(total.argmax(0))
            best = total.max(0) + row
        tags = [int((best + move[:, O]).argmax())]
        for step in reversed(back):
            tags.append(int(step[tags[-1]]))
        return tags[::-1]

    def outside(self, scores: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Tokens that the best path tags O whatever the others are: in any path with B or I there, O (and B for an I that follows) is better."""
        move, sure = self.transitions(), np.ones(len(scores), bool)
        begun = np.append(scores[1:, B] - scores[1:, I], 0)
        for x, froms in ((B, (O, B, I)), (I, (B, I))):
            gain = scores[:, O] - scores[:, x] + min(move[a, O] - move[a, x] for a in froms)
            plain = min(move[O, b] - move[x, b] for b in (O, B))
            follows = begun + move[O, B] - move[x, I] + min(move[B, c] - move[I, c] for c in (O, B, I))
            sure &= gain + np.where(last, plain, np.minimum(plain, follows)) > 1e-6
        return sure

    def decode(self, scores: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Tags of the best path of each text; what lies between tokens that are outside for sure is decoded by itself."""
        tags = np.zeros(len(scores), np.int8)
        open_ = np.flatnonzero(~self.outside(scores, last))
        if len(open_):
            for part in np.split(open_, np.flatnonzero((np.diff(open_) > 1) | last[open_[:-1]]) + 1):
                tags[part] = self.viterbi(scores[part[0] : part[-1] + 1])
        return tags

    def change(self, rows: np.ndarray, tags: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The slope of the log likelihood of pieces, by forward and backward sums of all at once; a piece is filled up with tokens that are outside.

        ``at`` has a row for each piece, with the places of its tokens in ``rows`` or -1.
        """
        move, score = np.exp(self.transitions()), self.scores(rows)
        held = np.exp(score - score.max(1, keepdims=True))
        held = np.concatenate([held, [[1.0, 0.0, 0.0]]])[at].transpose(1, 0, 2)
        n, m = held.shape[:2]
        ahead, behind, scale = np.zeros((n + 1, m, 3)), np.zeros((n + 1, m, 3)), np.ones((n, m, 1))
        ahead[0, :, O], behind[n] = 1, move[:, O]
        for k in range(n):
            now = (ahead[k] @ move) * held[k]
            scale[k] = now.sum(1, keepdims=True)
            ahead[k + 1] = now / scale[k]
        for k in range(n - 1, -1, -1):
            behind[k] = ((held[k] * behind[k + 1]) @ move.T) / scale[k]
        total = (ahead[n] * behind[n]).sum(1)[None, :, None]
        node = ahead[1:] * behind[1:] / total
        moved = move * (ahead[:-1].reshape(-1, 3).T @ (held * behind[1:] / scale / total).reshape(-1, 3))
        moved[:, O] += (ahead[n] * move[:, O] / total[0]).sum(0)
        gold = np.concatenate([tags, [O]])[at].T
        path = np.concatenate([np.zeros((1, m), int), gold, np.zeros((1, m), int)])
        seen = np.bincount((path[:-1] * 3 + path[1:]).ravel(), minlength=9).reshape(3, 3)
        rest = (np.eye(3)[gold] - node).transpose(1, 0, 2)[at >= 0]
        mine = rows[at[at >= 0]]
        large = np.abs(rest).max(1) > 1e-5
        slope = np.zeros_like(self.emit)
        for column in mine[large].T:
            for tag in (O, B, I):
                slope[:, tag] += np.bincount(column, rest[large, tag], len(slope))
        return slope, seen - moved


def values(raw: bytes) -> list[tuple[int, int, int]]:
    """(start of the whole span, start and end of the secret in it) of what the fixed patterns find, from left to right and without overlaps."""
    spans = [(m.start(), m.start(1), m.end(1)) for m in ASSIGN.finditer(raw) if m.end(1) - m.start(1) >= 6] + [(m.start(), m.start(), m.end()) for p in (ACCESS, HEX) for m in p.finditer(raw)]
    out: list[tuple[int, int, int]] = []
    for whole, a, b in sorted(spans):
        if not out or whole >= out[-1][2]:
            out.append((whole, a, b))
    return out


def labels(first: np.ndarray, end: np.ndarray, spans: Iterable[tuple[int, int, int]]) -> np.ndarray:
    """Tags of tokens: the first token of a secret is B, a further one I."""
    tags = np.zeros(len(first), np.int64)
    for _, a, b in spans:
        lo, hi = np.searchsorted(end, a, "right"), np.searchsorted(first, b)
        if hi > lo and not tags[lo:hi].any():
            tags[lo], tags[lo + 1 : hi] = B, I
    return tags


def doubtful(buf: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Tokens of 16 characters or more with both digits and letters."""
    digits, letters = _sums(DIGIT[buf]), _sums(TOKEN[buf] & ~DIGIT[buf] & (buf > 64) & (buf != 95))
    return (end - first >= 16) & (digits[end] > digits[first]) & (letters[end] > letters[first])


#: What made-up secrets are written with: words before them, what joins both, quotes, and the kinds of their characters.
LEADS = "password passwd pwd pass passphrase login secret token key apikey auth bearer credential credentials client_secret private access".split()
JOINTS = (" = ", "=", ": ", ":", " is ", " -> ", " := ", " - ", " ")
DIGITS_, LETTERS = b"0123456789", b"abcdefghijklmnopqrstuvwxyz"
ALPHABETS = (DIGITS_ + LETTERS + LETTERS.upper(), DIGITS_ + LETTERS + LETTERS.upper() + b"_-", DIGITS_ + LETTERS + LETTERS.upper() + b"+/", DIGITS_ + b"abcdef", DIGITS_ + b"ABCDEF", DIGITS_ + LETTERS, DIGITS_ + LETTERS.upper(), LETTERS + LETTERS.upper())


def made_up(raw: bytes, spans: list[tuple[int, int, int]], rng: np.random.Generator) -> tuple[bytes, list[tuple[int, int, int]]]:
    """The text with each secret and what announces it written anew, so that neither the patterns' words and marks nor their alphabets tell all secrets."""
    parts, out, at, size = [], [], 0, 0
    for whole, _, b in spans:
        parts.append(raw[at:whole])
        size += whole - at
        alphabet = np.frombuffer(ALPHABETS[rng.integers(len(ALPHABETS))], np.uint8)
        secret = rng.choice(alphabet, int(rng.integers(8, 16) if rng.random() < 0.3 else rng.integers(16, 65))).tobytes()
        lead = (LEADS[rng.integers(len(LEADS))] + JOINTS[rng.integers(len(JOINTS))]).encode() if rng.random() < 0.7 or len(secret) < 16 else b""
        lead = lead.upper() if rng.random() < 0.2 else lead
        quote = (b'"', b"'", b"`", b"")[rng.integers(4)]
        parts += [lead, quote, secret, quote if raw[b : b + 1] not in (b'"', b"'") else b""]
        size += len(lead) + len(quote)
        out.append((size - len(lead) - len(quote), size, size + len(secret)))
        size += len(secret) + len(parts[-1])
        at = b
    return b"".join([*parts, raw[at:]]), out


def fit(texts: list[str], epochs: int = 8, rate: float = 0.1, seed: int = 3, copies: int = 2) -> Field | None:
    """Learn from what the fixed patterns find, and from ``copies`` (more where few are found) of those texts with the found secrets written anew (``made_up``), from all tokens.

    Texts are cut where two tokens are outside into pieces of some ``PIECE`` tokens. Pieces with a token that no pattern finds, but that looks like a
    secret, teach nothing, since it may be one.
    """
    rows, tags, places, n = [], [], [], 0
    rng = np.random.default_rng(seed)
    copies = min(10 * copies, max(copies, -(-200 * copies // max(1, sum(bool(values(t.encode())) for t in texts)))))

    def examples() -> Iterator[tuple[bytes, list[tuple[int, int, int]]]]:
        for text in texts:
            raw = text.encode()
            spans = values(raw)
            yield raw, spans
            if spans:
                for _ in range(copies):
                    yield made_up(raw, spans, rng)

    for raw, spans in examples():
        buf, bounds = np.frombuffer(raw, np.uint8), np.array([0, len(raw)])
        first, end = candidates(buf, bounds)
        if not len(first):
            continue
        rows.extend(columns(buf, bounds, first, end))
        tags.append(labels(first, end, spans))
        at = np.arange(PIECE, len(first), PIECE)
        at = at[(tags[-1][at] == O) & (tags[-1][at - 1] == O)]
        doubt = _sums(doubtful(buf, first, end) & (tags[-1] == O))
        at = np.concatenate([[0], at, [len(first)]])
        sure = np.flatnonzero(doubt[at[1:]] == doubt[at[:-1]])
        places.extend(zip((n + at[sure]).tolist(), (n + at[sure + 1]).tolist(), strict=True))
        n += len(first)
    if not places:
        return None
    rows, tags = np.concatenate(rows), np.concatenate(tags)
    field = Field()
    size = max(1, min(1024, len(places) // 25))
    square = [np.full_like(field.emit, 1e-2), np.full_like(field.move, 1e-2)]
    places = np.array(places)
    # Words are learned slowly, so that what one word explains does not hide what the shape does.
    pace = np.where(np.arange(len(field.emit)) < OFFSET["before"], rate, rate / 10)[:, None]
    for _ in range(epochs):
        order = rng.permutation(len(places))
        for lo in range(0, len(order), size):
            part = places[order[lo : lo + size]]
            at = part[:, :1] + np.arange((part[:, 1] - part[:, 0]).max())
            at = np.where(at < part[:, 1:], at, -1)
            used, at = np.unique(at, return_inverse=True)
            at = at.reshape(len(part), -1) - (used[0] < 0)
            used = used[used >= 0]
            for weights, slope, seen, step in zip((field.emit, field.move), field.change(rows[used], tags[used], at), square, (pace, rate), strict=True):
                slope -= 1e-4 * weights
                seen += slope * slope
                weights += step * slope / np.sqrt(seen)
    return field


def joined(tokens: list[tuple[int, int]], tags: list[int], base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The spans of tagged tokens that no fixed pattern touches."""
    here: list[list[int]] = []
    for (a, b), tag in zip(tokens, tags, strict=True):
        if tag == B or tag == I and not here:
            here.append([a, b])
        elif tag == I:
            here[-1][1] = b
    return [(a, b, 3) for a, b in here if not any(s[0] < b and a < s[1] for s in base)]


def added(raw: bytes, tokens: list[tuple[int, int]], base: list[tuple[int, int, int]], field: Field) -> list[tuple[int, int, int]]:
    """Spans that the field tags and no fixed pattern touches."""
    return joined(tokens, field.viterbi(field.scores(features(raw, tokens))), base) if tokens else []


def digest(raw: bytes, spans: list[tuple[int, int, int]]) -> str:
    """kind:start:end by start, then kind as listed, in code points."""
    marks = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
    return ",".join(f"{KINDS[k]}:{marks[a]}:{marks[b]}" for a, b, k in sorted(spans, key=lambda s: (s[0], s[2], s[1])))


def _scan(field: Field | None, text_col: str, carry: list[str], schema: pa.Schema) -> Callable:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = hashlib.sha256(b"").hexdigest()
        for batch in slices(batches, text_col, 2 << 20):
            buf, bounds = utf8(batch.column(batch.schema.get_field_index(text_col)))
            n = batch.num_rows
            first, end = candidates(buf, bounds)
            owner = np.searchsorted(bounds, first, "right") - 1
            if field and len(first):
                scores = np.concatenate([field.scores(rows) for rows in columns(buf, bounds, first, end)])
                tags = field.decode(scores, np.append(owner[1:] != owner[:-1], True))
                tagged = np.flatnonzero(tags)
                first, end, owner, tags = first[tagged], end[tagged], owner[tagged], tags[tagged]
            else:
                first, end, owner, tags = first[:0], end[:0], owner[:0], np.zeros(0, np.int8)
            # The fixed patterns need a colon or equals sign, a capital A before K, or a long run of hex digits.
            hexes, _ = runs(LOWER_HEX[buf], bounds, HEX_RUN)
            marks = np.flatnonzero((buf == 58) | (buf == 61))
            keys = np.flatnonzero((buf[:-1] == 65) & (buf[1:] == 75)) if len(buf) else marks
            rows = np.unique(np.concatenate([owner, *(np.searchsorted(bounds, x, "right") - 1 for x in (hexes, marks, keys))]))
            counts, base_text, all_text = np.zeros((3, n), np.int64), [nothing] * n, [""] * n
            for k in rows.tolist():
                raw = buf[bounds[k] : bounds[k + 1]].tobytes()
                spans = base_spans(raw)
                mine = slice(np.searchsorted(owner, k), np.searchsorted(owner, k, "right"))
                tokens = [(int(a - bounds[k]), int(b - bounds[k])) for a, b in zip(first[mine], end[mine], strict=True)]
                more = joined(tokens, tags[mine].tolist(), spans)
                for s in spans:
                    counts[s[2], k] += 1
                if spans:
                    base_text[k] = hashlib.sha256(digest(raw, spans).encode()).hexdigest()
                if spans or more:
                    all_text[k] = digest(raw, spans + more)
            yield batch_of(schema, {c: batch.column(batch.schema.get_field_index(c)) for c in carry} | {"n_assign": counts[0], "n_access": counts[1], "n_hex": counts[2], "base_sha256": base_text, "spans": all_text})

    return scan


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, learn_rows: int = 4000, most_bytes: int = 1 << 16) -> DataFrame:
    """Find secrets in every whole text: those of three fixed patterns, and those that the random field adds.

    The field learns on the driver from a bounded sample of at most ``learn_rows`` texts of at most ``most_bytes`` that have
    two digits or a credential's word, those with the least hash of the id, labelled by the patterns; what these find is also learned in other words, marks, alphabets and lengths (``made_up``). Every token of every text may be tagged; decoding is exact
    (what is proven to be outside is left out of the search). Returns ``carry`` with n_assign, n_access, n_hex, base_sha256 and
    spans (``kind:start:end`` in code points, the field's as ``crf``). Null and empty texts have no spans; repeated rows each get a
    row, an empty table gives none; a carried column with the name of a result gives way to it. Documents are not shuffled.
    """
    carry = carried(docs, carry, text_col, ("n_assign", "n_access", "n_hex", "base_sha256", "spans"))
    numbered = docs.filter(F.col(id_col).isNotNull() & F.col(text_col).rlike(f"[0-9]{{2}}|(?i:{CREDENTIAL.pattern.decode()})") & (F.octet_length(text_col) <= most_bytes)).withColumn("_all", F.lit(0))
    chosen = hash_sample(numbered, "_all", id_col, learn_rows)
    sample = docs.filter(F.octet_length(text_col) <= most_bytes).join(F.broadcast(chosen), id_col, "left_semi")
    one = sample.groupBy(F.col(id_col).cast("string").alias("i")).agg(F.min(text_col).alias("t"))
    field = fit([r["t"] for r in sorted(one.collect(), key=lambda r: r["i"])])
    schema = T.StructType([*(docs.schema[c] for c in carry), *(T.StructField(c, T.LongType()) for c in ("n_assign", "n_access", "n_hex")), T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())])
    return arrow(docs.select(*dict.fromkeys([*carry, text_col])), _scan(field, text_col, carry, arrow_schema(schema)), schema)


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"), carry=["doc_id"])


def brute_force(text: str | None) -> tuple[int, int, int, str]:
    """The contract's fixed patterns on one text, in code points: for tests."""
    patterns = (re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+"))
    keep = (lambda m: len(m[1]) >= 6, lambda m: len(m[0]) >= 20, lambda m: len(m[0]) >= 24)
    found = [[m.span() for m in p.finditer(text or "") if k(m)] for p, k in zip(patterns, keep, strict=True)]
    line = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted((a, k, b) for k, x in enumerate(found) for a, b in x))
    return (*map(len, found), hashlib.sha256(line.encode()).hexdigest())
