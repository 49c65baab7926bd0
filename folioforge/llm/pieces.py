"""SentencePiece encoding by Gumbel top-k without replacement, and decoding.

The lattice of a text has a node at each character and an edge for each vocabulary piece (for a character the
vocabulary lacks, one edge of its UTF-8 byte pieces). An edge weighs -ALPHA ln(rank + 1), rank being the
piece's place in the merge order, which is the model's score with its sign changed (the number of pieces for one without); a segmentation's probability
is in proportion to exp(sum of weights). Backward sums over the lattice turn weights into exact probabilities
of the next piece at each node.

Perturbed A-star search. The root, all segmentations, has mass one and a Gumbel value. The best leaf below it
is a sample. What remains splits by the first decision at which a segmentation leaves that leaf, and each
such set has a known mass, so its largest perturbed value is a Gumbel of that mass truncated at the parent's.
The set with the largest value is opened next and gives the next sample, and so on: k distinct
segmentations in the order of their perturbed log-probabilities, as Gumbel top-k would draw them. The
largest value that is left over is the threshold kappa; a sample's inclusion score is
1 - exp(-exp(log_prob - kappa)), the chance that it exceeds it.

Random numbers are hashes of (seed, row key, place in the text, sample), so a row's samples do not depend on
how rows are dealt out. No piece crosses from a character to a space before a word, nor joins a character that
occurs in no longer piece, so lattices are built for such units, once a worker for each in a bounded store.

Defined results: a very long text is sampled whole, in memory of a multiple of its size; extra columns may have any name; a null or empty text has one segmentation, which is empty; fewer than k segmentations are all
returned, with inclusion 1; spaces and the space mark decode to a space; null row keys count as key 0; rows
that repeat get the same samples; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Grown, map_text

DEFAULT_FILE = "piece_bpe_32k.model"
SAMPLES = 2
ALPHA = 1.0
SEED = 11
MARK = "▁"
_U = np.uint64
_LOW = -np.inf


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(DEFAULT_FILE)


def plain(data: bytes) -> bytes:
    """Pieces' characters as text: marks are spaces, and the first is none of the text's."""
    data = data.replace(MARK.encode(), b" ")
    return data[1:] if data[:1] == b" " else data


class _Classes:
    """Characters that share a piece, directly or over others, are in one class; a piece never crosses from class to class."""

    MOST = 8

    def __init__(self):
        self.up: dict[str, str] = {}

    def _root(self, c: str) -> str:
        while self.up[c] != c:
            self.up[c] = c = self.up[self.up[c]]
        return c

    def add(self, body: str) -> None:
        for c in body:
            self.up.setdefault(c, c)
            self.up[self._root(c)] = self._root(body[0])

    def groups(self) -> list[list[str]]:
        """The MOST largest classes, and all others in one."""
        found: dict[str, list[str]] = {}
        for c in self.up:
            found.setdefault(self._root(c), []).append(c)
        ranked = sorted(found.values(), key=lambda x: (-len(x), x))
        rest = [c for x in ranked[self.MOST :] for c in x]
        return ranked[: self.MOST] + [rest] * bool(rest)


class Vocabulary:
    """Pieces as a trie in arrays, their weights and their bytes."""

    def __init__(self, path: str, alpha: float):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        self.surface: list[bytes] = [b""] * size
        self.weight = np.zeros(size)
        self.byte_id = np.zeros(256, dtype=np.int64)
        self.first = np.zeros(0x110000, dtype=np.int32)
        self.byte_weight = -alpha * math.log(size)
        step: dict[int, int] = {}
        of_node = [-1]
        joined = _Classes()
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_id[int(piece[1:-1], 16)] = i
                self.surface[i] = bytes([int(piece[1:-1], 16)])
                continue
            if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                continue
            self.surface[i] = piece.encode()
            self.weight[i] = -alpha * math.log(max(0.0, -model.get_score(i)) + 1) if model.get_score(i) > -1e8 else self.byte_weight
            if len(piece) > 1:
                body = piece.lstrip(MARK)
                if MARK in body:
                    raise ValueError(f"piece {piece!r} has a space mark after another character")
                joined.add(body)
            node = 0
            for c in map(ord, piece):
                key = node << 21 | c
                if key not in step:
                    step[key] = len(of_node)
                    of_node.append(-1)
                node = step[key]
            of_node[node] = i
        keys = np.array(sorted(step), dtype=np.int64)
        self.step_key, self.step_to = keys, np.array([step[k] for k in keys.tolist()], dtype=np.int64)
        top = keys < 1 << 21
        self.first[keys[top]] = self.step_to[top]
        self.piece = np.array(of_node)
        inside = ["".join(map(re.escape, sorted(x))) for x in joined.groups()]
        own = "|".join(f"{MARK}*[{x}]+" for x in inside)
        self.units = re.compile(f"{own}|{MARK}+|[^{MARK}{''.join(inside)}]", re.DOTALL)
        length = np.array([len(x) for x in self.surface])
        self.at, self.length = np.cumsum(length) - length, length
        self.flat = np.frombuffer(b"".join(self.surface), dtype=np.uint8)

    def spelled(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """The pieces' characters of rows of ids that end at ends, in UTF-8."""
        n = self.length[ids]
        end = np.cumsum(n)
        data = self.flat[np.repeat(self.at[ids] - end + n, n) + np.arange(end[-1] if len(end) else 0)].tobytes()
        stop = np.concatenate([[0], end])[ends].tolist()
        return [data[a:b] for a, b in zip([0, *stop], stop, strict=False)]

    def decode(self, ids: np.ndarray) -> bytes:
        """Text of a row of ids, in UTF-8."""
        return plain(self.spelled(ids, np.array([len(ids)]))[0])


class Lattices(dict):
    """Unit -> number; lattices of all units in flat arrays. Units seen once are dropped when LIMIT is passed."""

    LIMIT = 240_000

    def __init__(self, vocab: Vocabulary):
        super().__init__()
        self.vocab, self.names = vocab, []
        self._empty()

    def _empty(self) -> None:
        self.clear()
        self.names, self.done = [], 0
        # first: of each node, edges of earlier nodes, and one more at the end; node: of each edge.
        self.grown = {c: Grown(k) for c, k in (("start", np.int64), ("ends", bool), ("first", np.int64), ("target", np.int32), ("code", np.int32), ("logp", float), ("cdf", float), ("node", np.int32), ("seen", np.int32))}
        self._add(**{c: x.all for c, x in self.grown.items()})
        self._add(first=np.zeros(1, dtype=np.int64))

    def _add(self, **more: np.ndarray) -> None:
        for name, x in more.items():
            self.grown[name].add(x)
            setattr(self, name, self.grown[name].all)

    def __missing__(self, unit: str) -> int:
        i = self[unit] = len(self.names)
        self.names.append(unit)
        return i

    def numbers(self, units: list[str]) -> np.ndarray:
        if len(self.names) > self.LIMIT:
            self._keep(np.flatnonzero(self.seen > 1)[: self.LIMIT // 2])
        at = np.fromiter(map(self.__getitem__, units), dtype=np.int64, count=len(units))
        if self.done < len(self.names):
            self._build(self.names[self.done :])
            self.done = len(self.names)
        self._add(seen=np.zeros(len(self.names) - self.grown["seen"].n, dtype=np.int32))
        self.seen += np.bincount(at, minlength=len(self.names)).astype(np.int32)
        return at

    def _keep(self, units: np.ndarray) -> None:
        """Drops all units but these, in order, without building any anew."""
        names = [self.names[i] for i in units.tolist()]
        size = np.array([len(x) + 1 for x in names], dtype=np.int64)
        start = np.cumsum(size) - size
        nodes = _stretches(self.start[units], size)
        lo = self.first[self.start[units]]
        fan = self.first[nodes + 1] - self.first[nodes]
        edges = _stretches(lo, self.first[self.start[units] + size] - lo)
        node = np.repeat(np.arange(len(nodes)), fan)
        shift = np.repeat(nodes - np.arange(len(nodes)), fan)
        kept = {"start": start, "ends": self.ends[nodes], "first": np.cumsum(fan), "target": self.target[edges] - shift, "code": self.code[edges],
                "logp": self.logp[edges], "cdf": self.cdf[edges], "node": node, "seen": np.ones(len(names), dtype=np.int32)}
        self._empty()
        self._add(**kept)
        self.names, self.done = names, len(names)
        self.update(zip(names, range(len(names)), strict=True))

    def _build(self, units: list[str]) -> None:
        v = self.vocab
        cp = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        size = np.array([len(x) for x in units], dtype=np.int64)
        unit = np.repeat(np.arange(len(units)), size)
        end = np.cumsum(size)[unit]
        pos, node, depth = np.arange(len(cp)), v.first[cp].astype(np.int64), 1
        found = []
        missing = v.piece[node] < 0
        lone = np.flatnonzero(missing | (node == 0))
        found.append((lone, np.ones(len(lone), dtype=np.int64), -1 - cp[lone]))
        live = node > 0
        pos, node = pos[live], node[live]
        while len(pos):
            piece = v.piece[node]
            hit = piece >= 0
            found.append((pos[hit], np.full(hit.sum(), depth), piece[hit]))
            more = pos + depth < end[pos]
            pos, node = pos[more], node[more]
            key = node << 21 | cp[pos + depth]
            at = np.minimum(np.searchsorted(v.step_key, key), len(v.step_key) - 1)
            ok = v.step_key[at] == key
            pos, node, depth = pos[ok], v.step_to[at[ok]], depth + 1
        p, n, code = (np.concatenate(x) for x in zip(*found, strict=True))
        # Nodes: a unit of L characters has L + 1; a node is a character's place plus the units before it.
        weight = v.weight[np.maximum(code, 0)]
        rare = np.flatnonzero(code < 0)
        weight[rare] = v.byte_weight * _utf8_size(-1 - code[rare])
        left = end[p] - p
        order = np.argsort(left << 40 | p << 5 | n)
        p, n, code, weight, left = p[order], n[order], code[order], weight[order], left[order]
        src = p + unit[p]
        dst = src + n
        beta = np.zeros(len(cp) + len(units))
        cut = np.flatnonzero(np.concatenate([[True], src[1:] != src[:-1]])) if len(src) else np.zeros(0, dtype=np.int64)
        level = np.flatnonzero(np.concatenate([[True], np.diff(left[cut]) != 0])) if len(cut) else []
        bounds = [*(cut[level].tolist() if len(cut) else []), len(src)]
        firsts = [*(level.tolist() if len(cut) else []), len(cut)]
        for k in range(len(bounds) - 1):
            a, b = bounds[k], bounds[k + 1]
            nodes = cut[firsts[k] : firsts[k + 1]] - a
            x = weight[a:b] + beta[dst[a:b]]
            top = np.maximum.reduceat(x, nodes)
            total = np.add.reduceat(np.exp(x - np.repeat(top, np.diff(np.append(nodes, b - a)))), nodes)
            beta[src[a + nodes]] = top + np.log(total)
        logp = np.minimum(weight + beta[dst] - beta[src], 0.0)
        # Likely edges first, so that a walk seldom looks past the first edge of a node.
        share = np.exp(logp)
        order = np.argsort(src << 26 | ((1.0 - share) * 2.0**20).astype(np.int64) << 5 | n)
        src, dst, code, logp, share = src[order], dst[order], code[order], logp[order], share[order]
        run = np.cumsum(share)
        cut = np.flatnonzero(np.concatenate([[True], src[1:] != src[:-1]])) if len(src) else np.zeros(0, dtype=np.int64)
        run -= np.repeat(run[cut] - share[cut], np.diff(np.append(cut, len(src))))
        run[np.append(cut[1:], len(src)) - 1] = 2.0
        before = len(self.ends)
        begin = np.cumsum(size + 1) - (size + 1)
        ends = np.zeros(len(beta), dtype=bool)
        ends[begin + size] = True
        fan = np.bincount(src, minlength=len(beta))
        self._add(start=begin + before, ends=ends, target=dst + before, code=code, logp=logp, cdf=run, node=src + before, first=self.first[-1] + np.cumsum(fan))

    def walk(self, node: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Samples a path from each node to its unit's end: the edges one path after another, and each path's length."""
        act = np.flatnonzero(~self.ends[node])
        length = np.zeros(len(node), dtype=np.int64)
        at, steps, step = node[act], [], 0
        while len(act):
            u = _uniform(key[act] + _times(step, 0x9E3779B97F4A7C15))
            edge = self.first[at]
            past = np.flatnonzero(self.cdf[edge] <= u)
            while len(past):
                edge[past] += 1
                past = past[self.cdf[edge[past]] <= u[past]]
            steps.append((act, edge))
            length[act] += 1
            at = self.target[edge]
            on = ~self.ends[at]
            act, at, step = act[on], at[on], step + 1
        out = np.zeros(length.sum(), dtype=np.int64)
        begin = np.cumsum(length) - length
        for i, (a, edge) in enumerate(steps):
            out[begin[a] + i] = edge
        return out, length

    def leave(self, edge: int, barred: list[int], u: float) -> int:
        """Another edge of the same node, none of those barred, by its probability."""
        node = self.node[edge]
        free = [e for e in range(self.first[node], self.first[node + 1]) if e not in barred]
        if len(free) == 1:
            return free[0]
        p = np.exp(self.logp[free])
        return free[min(int(np.searchsorted(np.cumsum(p), u * p.sum(), side="right")), len(free) - 1)]

    def ids(self, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of edges, and how many each edge gives."""
        code = self.code[edges]
        n = np.where(code >= 0, 1, 0)
        if (code >= 0).all():
            return code, n
        rare = code < 0
        points = -1 - code[rare]
        n[rare] = _utf8_size(points)
        out = np.repeat(code, n)
        raw = points.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
        out[np.repeat(rare, n)] = self.vocab.byte_id[np.frombuffer(raw, dtype=np.uint8)]
        return out, n


def _stretches(lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """lo[i], lo[i] + 1, ... n[i] numbers for each i, one after another."""
    return np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())


def _times(n: int, odd: int) -> np.uint64:
    return _U(n * odd & 0xFFFFFFFFFFFFFFFF)


def _utf8_size(cp: np.ndarray) -> np.ndarray:
    return 1 + (cp > 0x7F) + (cp > 0x7FF) + (cp > 0xFFFF)


def _uniform(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return (((x ^ (x >> _U(31))) >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53


def _gumbel(x: np.ndarray) -> np.ndarray:
    return -np.log(-np.log(_uniform(x)))


def _truncated(mass: np.ndarray, bound: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Gumbels of given log masses, none above its bound."""
    with np.errstate(over="ignore", divide="ignore"):
        return np.where(mass > _LOW, -np.logaddexp(-bound, -(mass + _gumbel(key))), _LOW)


class _Sample:
    """A sample of every document of a batch: decisions end to end, and the sets that leave it."""

    def __init__(self, edges, ends, unit, logp, frozen, bound, key):
        self.edges, self.ends, self.unit = edges, ends, unit
        self.begin = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        n = ends - self.begin
        doc = np.repeat(np.arange(len(ends)), n)
        run = np.cumsum(logp) - logp
        self.prefix = run - run[np.minimum(self.begin, max(len(run) - 1, 0))][doc] if len(run) else run
        self.total = np.bincount(doc, weights=logp, minlength=len(ends))
        self.out = np.exp(logp)  # probability that has left a decision so far
        with np.errstate(divide="ignore"):
            mass = self.prefix + np.log1p(-np.minimum(self.out, 1.0))
        mass[np.arange(len(edges)) < np.repeat(self.begin + frozen, n)] = _LOW
        mass[self.out > 1 - 1e-12] = _LOW
        self.value = _truncated(mass, bound[doc], key[doc] + np.arange(len(edges)).astype(_U) * _U(0xD1342543DE82EF95) - self.begin[doc].astype(_U) * _U(0xD1342543DE82EF95))
        self.barred: dict[int, list[int]] = {}

    def best(self) -> tuple[np.ndarray, np.ndarray]:
        """Largest open value of each document and its place."""
        top = np.full(len(self.ends), _LOW)
        at = np.zeros(len(self.ends), dtype=np.int64)
        some = np.flatnonzero(self.ends > self.begin)
        if len(some):
            top[some] = np.maximum.reduceat(self.value, self.begin[some])
            doc = np.repeat(np.arange(len(self.ends)), self.ends - self.begin)
            hit = np.flatnonzero(self.value == top[doc])
            at[doc[hit[::-1]]] = hit[::-1]
        return top, at


def sample_batch(lat: Lattices, texts: list[str | None], keys: np.ndarray, k: int):
    """For each sample in turn: (documents that have it, edges, ends, log probability, perturbed value); then kappa."""
    split = [lat.vocab.units.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
    count = np.array([len(x) for x in split], dtype=np.int64)
    units = lat.numbers([u for x in split for u in x])
    unit_end = np.cumsum(count)
    place = np.arange(len(units)) - np.repeat(unit_end - count, count)
    doc = np.repeat(np.arange(len(texts)), count)
    unit_key = (keys[doc] ^ (place.astype(_U) * _U(0xA24BAED4963EE407))) * _U(0x9FB21C651E98DF25)
    edges, length = lat.walk(lat.start[units], unit_key)
    ends = np.cumsum(np.bincount(doc, weights=length, minlength=len(texts)).astype(np.int64))
    root = _gumbel(keys * _U(0xFF51AFD7ED558CCD) + _U(1))
    samples = [_Sample(edges, ends, np.repeat(np.arange(len(units)), length), lat.logp[edges], np.zeros(len(texts), dtype=np.int64), root, keys)]
    emitted = [(np.arange(len(texts)), edges, ends, samples[0].total, root)]
    values = [root]
    for r in range(1, k + 1):
        tops = [s.best() for s in samples]
        which = np.argmax([t[0] for t in tops], axis=0)
        top = np.max([t[0] for t in tops], axis=0)
        values.append(top)
        docs = np.flatnonzero(top > _LOW)
        if r == k or not len(docs):
            break
        salt = keys + _times(r, 0xC2B2AE3D27D4EB4F)
        draw = _uniform(salt[docs] ^ _U(0x165667B19E3779F9))
        heads, from_node, from_key, froms = [], [], [], []
        for d, u in zip(docs.tolist(), draw.tolist(), strict=True):
            s, at = samples[which[d]], int(tops[which[d]][1][d])
            barred = s.barred.setdefault(at, [int(s.edges[at])])
            edge = lat.leave(int(s.edges[at]), barred, u)
            barred.append(edge)
            s.out[at] += math.exp(lat.logp[edge])
            left = 1.0 - s.out[at]
            mass = s.prefix[at] + math.log(left) if left > 1e-12 else _LOW
            s.value[at] = _truncated(np.array([mass]), np.array([top[d]]), salt[d : d + 1] + _U(7))[0]
            own = int(s.unit[at])
            heads.append((s.edges[s.begin[d] : at], s.unit[s.begin[d] : at], edge, own))
            rest = np.arange(own, unit_end[d])
            nodes = lat.start[units[rest]]
            nodes[0] = lat.target[edge]
            from_node.append(nodes)
            from_key.append(unit_key[rest] + _times(r, 0x8CB92BA72F3D8DD7))
            froms.append(rest)
        tails, tail_len = lat.walk(np.concatenate(from_node), np.concatenate(from_key))
        tail_unit = np.repeat(np.concatenate(froms), tail_len)
        cut = np.cumsum([len(x) for x in froms])
        tail_end = np.concatenate([[0], np.cumsum(tail_len)])[cut]
        parts, unit_parts, frozen, size, last = [], [], np.zeros(len(texts), dtype=np.int64), np.zeros(len(texts), dtype=np.int64), 0
        for d, (edges0, unit0, edge, own), end in zip(docs.tolist(), heads, tail_end.tolist(), strict=True):
            parts += [edges0, [edge], tails[last:end]]
            unit_parts += [unit0, [own], tail_unit[last:end]]
            frozen[d], size[d] = len(edges0) + 1, len(edges0) + 1 + end - last
            last = end
        edges = np.concatenate(parts).astype(np.int64)
        ends = np.cumsum(size)
        new = _Sample(edges, ends, np.concatenate(unit_parts).astype(np.int64), lat.logp[edges], frozen, top, salt)
        samples.append(new)
        emitted.append((docs, edges, ends, new.total, top))
    kappa = values[k] if len(values) > k else np.full(len(texts), _LOW)
    return emitted, kappa


_OPEN: dict[tuple[str, float], Lattices] = {}


def lattices(path: str, alpha: float) -> Lattices:
    if (path, alpha) not in _OPEN:
        _OPEN[path, alpha] = Lattices(Vocabulary(path, alpha))
    return _OPEN[path, alpha]


def sampled_encodings(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SAMPLES, alpha: float = ALPHA,
                      seed: int = SEED, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """doc_id, sample, n_pieces, ids_crc32, log_prob, perturbed, inclusion, round_trip (and ids) of every row and sample."""
    path = path or default_path()
    names = ["doc_id", "sample", "n_pieces", "ids_crc32", "log_prob", "perturbed", "inclusion", "round_trip"]
    schema = "doc_id long, sample int, n_pieces long, ids_crc32 long, log_prob double, perturbed double, inclusion double, round_trip boolean"

    def f(batch: pa.RecordBatch) -> pa.RecordBatch:
        lat = lattices(path, alpha)
        texts = batch.column("text").to_pylist()
        doc_ids = batch.column("doc_id").to_pylist()
        keys = np.array([xxhash.xxh64_intdigest((x or 0).to_bytes(8, "little", signed=True), seed) for x in doc_ids], dtype=_U)
        emitted, kappa = sample_batch(lat, texts, keys, k)
        want = [(t or "").replace(MARK, " ").encode("utf-8", "surrogatepass") for t in texts]
        rows, lists = [], []
        for s, (docs, edges, ends, total, value) in enumerate(emitted):
            ids, n = lat.ids(edges)
            id_end = np.concatenate([[0], np.cumsum(n)])[ends]
            begin, stop, spelled, low = np.append(0, id_end[:-1]).tolist(), id_end.tolist(), lat.vocab.spelled(ids, id_end), ids.astype("<u4")
            for d in docs.tolist():
                own = ids[begin[d] : stop[d]]
                inclusion = 1.0 if kappa[d] == _LOW else -math.expm1(-math.exp(min(total[d] - kappa[d], 700.0)))
                rows.append((doc_ids[d], s, len(own), zlib.crc32(low[begin[d] : stop[d]]), total[d], value[d], inclusion, plain(spelled[d]) == want[d]))
                if with_ids:
                    lists.append(own)
        cols = list(zip(*rows, strict=True)) or [()] * 8
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.bool_()]
        arrays = [pa.array(c, t) for c, t in zip(cols, kinds, strict=True)]
        return pa.RecordBatch.from_arrays([*arrays, *([pa.array(lists, pa.list_(pa.int64()))] if with_ids else [])], [*names, *(["ids"] if with_ids else [])])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_text(rows, "text", f, schema + (", ids array<bigint>" if with_ids else ""))


def op5_sentencepiece(spark, sf_dir: str) -> DataFrame:
    return sampled_encodings(spark.read.parquet(f"{sf_dir}/documents.parquet"))
