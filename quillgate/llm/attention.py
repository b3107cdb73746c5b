"""A small causal self-attention model over subword ids, trained and run in numpy.

A window of `WIDTH` inputs scores the last `STEP` of its targets: consecutive windows overlap by WIDTH - STEP inputs, so each
token is scored once and sees at least that many inputs before it. One attention layer and one hidden layer, both added to the
input, feed a softmax of two levels: the `HEAD` most frequent ids and `GROUPS` groups, then the `MEMBERS` of the target's group, each
member with its own learnt vector. A group's last member stands for all rarer ids of the group, which share it by their counts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

WIDTH, STEP, DIM, HIDDEN = 32, 24, 32, 64
HEAD, GROUPS, MEMBERS, NEAR, CONTEXTS = 96, 32, 32, 8, 128
INPUTS, OWN_INPUT = 3072, 2048
BATCH = 128
#: Rows of logits and numbers of Adam's means that are worked on at once.
HEAD_ROWS, ADAM_RUN = 576, 1 << 14
START, PAD = INPUTS, INPUTS + 1  # rows of the input table
BEFORE, OUTSIDE = -2, -1  # in windows: what precedes a text's first id, and places that no text has


@dataclass
class Vocabulary:
    """By subword id: row of the input table, place in the first softmax, place in its group (-1: none), and log10 of its share of
    that place."""

    row: np.ndarray
    head: np.ndarray
    member: np.ndarray
    share: np.ndarray
    table: np.ndarray | None = None  # see inputs()

    @classmethod
    def of(cls, counts: np.ndarray, sample: np.ndarray, seed: int = 0) -> Vocabulary:
        """counts: of each id in the corpus; sample: ids of texts, from which groups of ids with like neighbours are made."""
        n = len(counts)
        by_count = np.lexsort((np.arange(n), -counts))
        row = OWN_INPUT + np.arange(n) % (INPUTS - OWN_INPUT)
        row[by_count[:OWN_INPUT]] = np.arange(min(n, OWN_INPUT))
        head, member = np.empty(n, np.int64), np.full(n, MEMBERS - 1)
        head[by_count[:HEAD]] = np.arange(min(n, HEAD))
        member[by_count[:HEAD]] = -1
        own, rest = by_count[HEAD : HEAD + GROUPS * (MEMBERS - 1)], by_count[HEAD + GROUPS * (MEMBERS - 1) :]
        group = _clusters(by_count, sample, GROUPS, seed)
        own = own[np.argsort(group[own], kind="stable")]  # groups of one size, cut from the clusters in their order
        head[own] = HEAD + np.arange(len(own)) // (MEMBERS - 1)
        member[own] = np.arange(len(own)) % (MEMBERS - 1)
        home = np.zeros(GROUPS, np.int64)
        home[group[own]] = head[own] - HEAD
        head[rest] = HEAD + home[group[rest]]
        place = head * MEMBERS + np.maximum(member, 0)
        total = np.bincount(place, counts + 0.5)
        return cls(row, head, member, np.log10((counts + 0.5) / total[place]))

    def inputs(self, raw: np.ndarray) -> np.ndarray:
        """Rows of the input table of windows. BEFORE and OUTSIDE count from the end."""
        if self.table is None:
            self.table = np.concatenate([self.row, [START, PAD]]).astype(np.int32)
        return self.table[raw]


def _clusters(by_count: np.ndarray, sample: np.ndarray, k: int, seed: int, rounds: int = 15) -> np.ndarray:
    """One of k groups for each id: k-means over square roots of how often frequent ids stand within NEAR places."""
    n = len(by_count)
    rank = np.empty(n, np.int64)
    rank[by_count] = np.arange(n)
    out = np.arange(n) % k
    ids = np.flatnonzero((np.bincount(sample, minlength=n) > 0) & (rank >= HEAD))
    if len(ids) < 2 * k:
        return out
    at = np.full(n, -1)
    at[ids] = np.arange(len(ids))
    f = np.zeros(len(ids) * CONTEXTS)
    for step in range(1, NEAR + 1):
        for a, b in ((sample[:-step], sample[step:]), (sample[step:], sample[:-step])):
            use = (at[a] >= 0) & (rank[b] < CONTEXTS)
            f += np.bincount(at[a[use]] * CONTEXTS + rank[b[use]], minlength=len(f))
    f = np.sqrt(f.reshape(-1, CONTEXTS) + 0.01)
    f /= np.sqrt((f * f).sum(1, keepdims=True))
    centre = f[np.random.default_rng(seed).permutation(len(f))[:k]]
    for _ in range(rounds):
        group = (f @ centre.T).argmax(1)
        for g in np.unique(group):
            c = f[group == g].sum(0)
            centre[g] = c / np.sqrt((c * c).sum())
    out[ids] = group
    return out


def windows(ids: np.ndarray, sizes: np.ndarray, some: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Windows of all texts: WIDTH inputs and one more id, so that input t is followed by its target at t + 1; and the number of
    the target (of all texts' ids) that each scored place has, or -1. ids: the texts' ids one after the other; some: the numbers
    of the windows to make, if not all."""
    steps = -(-sizes // STEP)
    first = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    text = np.repeat(np.arange(len(sizes)), steps)
    step = np.arange(steps.sum()) - np.repeat(np.cumsum(steps) - steps, steps)
    if some is not None:
        text, step = text[some], step[some]
    t = step[:, None] * STEP + np.arange(STEP - WIDTH - 1, STEP)
    inside = (t >= 0) & (t < sizes[text][:, None])
    at = np.where(inside, first[text][:, None] + t, 0)
    raw = np.where(inside, ids[at] if len(ids) else 0, np.where(t == -1, BEFORE, OUTSIDE)).astype(np.int32)
    return raw, np.where(inside, at, -1)[:, WIDTH + 1 - STEP :]


#: Added to the scores: places after the one that asks count for nothing.
_LATER = np.where(np.arange(WIDTH)[None, :] <= np.arange(WIDTH - STEP, WIDTH)[:, None], 0, -1e9).astype(np.float32)


def _log_sum(logits: np.ndarray, most: float = np.inf) -> np.ndarray:
    """Log of each row's sum of exponentials; logits are overwritten. most: a bound of them, if one is known."""
    one = np.ones(logits.shape[1], logits.dtype)
    if most <= 60 or logits.max(initial=0) <= 60:  # no row overflows
        return np.log(np.exp(logits, out=logits) @ one)
    m = logits.max(1, keepdims=True)
    logits -= m
    return np.log(np.exp(logits, out=logits) @ one) + m[:, 0]


def _by_group(group: np.ndarray) -> list[tuple[int, np.ndarray]]:
    order = np.argsort(group, kind="stable")
    cuts = np.flatnonzero(np.diff(group[order])) + 1
    return [(int(group[x[0]]), x) for x in np.split(order, cuts) if len(x)]


class Model:
    def __init__(self, seed: int = 0, vocabulary: Vocabulary | None = None, counts: np.ndarray | None = None):
        r = np.random.default_rng(seed)
        w = lambda *s: (r.standard_normal(s) / np.sqrt(s[-2])).astype(np.float32)
        u, t = 0.3 * w(DIM + 1, HEAD + GROUPS), 0.3 * w(GROUPS, DIM + 1, MEMBERS)
        u[DIM], t[:, DIM] = 0, 0
        if vocabulary is not None:  # the last rows are biases
            u[DIM] = _log_share(np.bincount(vocabulary.head, counts, HEAD + GROUPS))
            tail = vocabulary.member >= 0
            n = np.bincount((vocabulary.head[tail] - HEAD) * MEMBERS + vocabulary.member[tail], counts[tail], GROUPS * MEMBERS)
            t[:, DIM] = _log_share(n.reshape(GROUPS, MEMBERS))
        self.p = {"E": 0.3 * r.standard_normal((INPUTS + 2, DIM)).astype(np.float32), "P": 0.1 * r.standard_normal((WIDTH, DIM)).astype(np.float32), "Q": w(DIM, DIM), "K": w(DIM, DIM), "V": w(DIM, DIM), "O": w(DIM, DIM), "A": w(DIM, HIDDEN), "a": np.zeros(HIDDEN, np.float32), "B": 0.3 * w(HIDDEN, DIM), "U": u, "T": t}

    def flat(self) -> np.ndarray:
        """All parameters one after the other."""
        return np.concatenate([v.ravel() for v in self.p.values()])

    def with_flat(self, flat: np.ndarray) -> Model:
        self.p = self._views(flat.astype(np.float32))
        return self

    def _views(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        """Parts of such an array, shaped like the parameters."""
        ends = np.cumsum([v.size for v in self.p.values()])
        return {k: flat[z - v.size : z].reshape(v.shape) for (k, v), z in zip(self.p.items(), ends, strict=True)}

    def folded(self) -> dict[str, np.ndarray]:
        """Products of matrices that scoring applies one after the other: queries meet inputs as they are, and the inputs' weighted
        sums, not each input, become values."""
        p = self.p
        return {"QK": p["Q"] @ p["K"].T * np.float32(DIM**-0.5), "VO": p["V"] @ p["O"], "A": np.concatenate([p["A"], p["a"][None]]), "u": np.sqrt((p["U"] ** 2).sum(0).max())}

    def hidden(self, x: np.ndarray, f: dict[str, np.ndarray]) -> np.ndarray:
        """What the softmax reads for each scored place, a one at its end."""
        p, n = self.p, len(x)
        e = np.take(p["E"], x, axis=0)
        e += p["P"]
        own = e[:, WIDTH - STEP :].reshape(-1, DIM)
        s = (own @ f["QK"]).reshape(n, STEP, DIM) @ e.transpose(0, 2, 1)
        s += _LATER
        part = np.flatnonzero(x[:, 0] == PAD)  # only a text's first windows have unused places that a scored one sees
        if len(part):
            s[part] = np.where((x[part] == PAD)[:, None, :], np.float32(-1e9), s[part])
        if s.max(initial=0) > 60:
            s -= s.max(2, keepdims=True)
        np.exp(s, out=s)
        c = s @ e
        c /= (s.reshape(-1, WIDTH) @ np.ones(WIDTH, np.float32)).reshape(n, STEP, 1)
        z = np.empty((n * STEP, DIM + 1), np.float32)
        z[:, DIM] = 1
        np.add(own, c.reshape(-1, DIM) @ f["VO"], out=z[:, :DIM])
        h = z @ f["A"]
        np.maximum(h, 0, out=h)
        z[:, :DIM] += h @ p["B"]
        return z

    def gradients(self, x: np.ndarray, head: np.ndarray, member: np.ndarray, mask: np.ndarray, g: dict[str, np.ndarray] | None = None) -> tuple[dict[str, np.ndarray], float]:
        """head, member, mask: of the scored places, flat. Like hidden(), by products of matrices: the gradients of both factors follow
        from that of their product. g: arrays that take the gradients, if given."""
        p, n = self.p, len(x)
        kind = p["E"].dtype
        g = {k: np.empty_like(v) for k, v in p.items()} if g is None else g
        one = np.ones(max(HEAD + GROUPS, WIDTH, MEMBERS), kind)
        weight = (mask / max(int(mask.sum()), 1)).astype(kind)
        qk, vo = p["Q"] @ p["K"].T * kind.type(DIM**-0.5), p["V"] @ p["O"]
        hidden = np.concatenate([p["A"], p["a"][None]])
        loss = 0.0

        def softmax(d: np.ndarray, target: np.ndarray, weight: np.ndarray) -> None:
            """Makes logits their gradients."""
            nonlocal loss
            if d.max(initial=0) > 60:
                d -= d.max(1, keepdims=True)
            at = np.arange(len(d)) * d.shape[1] + target
            flat = d.ravel()
            own = flat[at].astype(float)
            np.exp(d, out=d)
            total = d @ one[: d.shape[1]]
            loss -= float(((own - np.log(total)) * weight).sum())
            d *= (weight / total)[:, None]
            flat[at] -= weight

        e = np.take(p["E"], x, axis=0)
        e += p["P"]
        own = e[:, WIDTH - STEP :].reshape(-1, DIM)
        q, back = (own @ qk).reshape(n, STEP, DIM), e.transpose(0, 2, 1)
        s = q @ back
        s += _LATER
        part = np.flatnonzero(x[:, 0] == PAD)  # only a text's first windows have unused places that a scored one sees
        if len(part):
            s[part] = np.where((x[part] == PAD)[:, None, :], kind.type(-1e9), s[part])
        if s.max(initial=0) > 60:
            s -= s.max(2, keepdims=True)
        np.exp(s, out=s)
        s *= (1 / (s.reshape(-1, WIDTH) @ one[:WIDTH])).reshape(n, STEP, 1)
        c = (s @ e).reshape(-1, DIM)
        y = np.empty((n * STEP, DIM + 1), kind)
        y[:, DIM] = 1
        np.add(own, c @ vo, out=y[:, :DIM])
        h = y @ hidden
        np.maximum(h, 0, out=h)
        z = y.copy()
        z[:, :DIM] += h @ p["B"]

        g["U"][:], dz = 0, np.empty((n * STEP, DIM), kind)
        for a in range(0, n * STEP, HEAD_ROWS):  # so few that their logits stay in the cache
            i = slice(a, a + HEAD_ROWS)
            d = z[i] @ p["U"]
            softmax(d, head[i], weight[i])
            g["U"] += z[i].T @ d
            np.matmul(d, p["U"][:DIM].T, out=dz[i])
        tail = np.flatnonzero((head >= HEAD) & mask)
        tail = tail[np.argsort(head[tail].astype(np.uint16), kind="stable")]
        cuts = np.searchsorted(head[tail], np.arange(HEAD, HEAD + GROUPS + 1)).tolist()
        groups = [(k, slice(a, b)) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if a < b]
        of_tail, d = z[tail], np.empty((len(tail), MEMBERS), kind)
        for k, i in groups:
            np.matmul(of_tail[i], p["T"][k], out=d[i])
        softmax(d, member[tail], weight[tail])
        g["T"][:] = 0
        dt = np.empty((len(tail), DIM), kind)
        for k, i in groups:
            np.matmul(of_tail[i].T, d[i], out=g["T"][k])
            np.matmul(d[i], p["T"][k, :DIM].T, out=dt[i])
        dz[tail] += dt

        np.matmul(h.T, dz, out=g["B"])
        dh = dz @ p["B"].T
        dh *= h > 0
        both = y.T @ dh
        g["A"][:], g["a"][:] = both[:DIM], both[DIM]
        dz += dh @ p["A"].T
        both = c.T @ dz
        np.matmul(both, p["O"].T, out=g["V"])
        np.matmul(p["V"].T, both, out=g["O"])
        dc = (dz @ vo.T).reshape(n, STEP, DIM)
        ds = dc @ back
        ds *= s
        s_ds = ds.reshape(-1, WIDTH) @ one[:WIDTH]
        de = s.transpose(0, 2, 1) @ dc
        s *= s_ds.reshape(n, STEP, 1)
        ds -= s
        dq = (ds @ e).reshape(-1, DIM)
        de += ds.transpose(0, 2, 1) @ q
        both = own.T @ dq * kind.type(DIM**-0.5)
        np.matmul(both, p["K"], out=g["Q"])
        np.matmul(both.T, p["Q"], out=g["K"])
        dz += dq @ qk.T
        de[:, WIDTH - STEP :] += dz.reshape(n, STEP, DIM)
        de.sum(0, out=g["P"])
        rows = x.ravel().astype(np.uint16)
        order = np.argsort(rows, kind="stable")
        rows = rows[order]
        starts = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
        g["E"][:] = 0
        g["E"][rows[starts]] = np.add.reduceat(np.take(de.reshape(-1, DIM), order, axis=0), starts, axis=0)
        return g, loss

    def train(self, raw: np.ndarray, vocabulary: Vocabulary, steps: int, batch: int = 96, rates: tuple[float, float] = (0.01, 0.0005), seed: int = 0) -> list[float]:
        """Adam over batches of windows(), the rate going from the first to the second; without windows nothing changes. No window
        comes again before all have come."""
        r, losses, queue = np.random.default_rng(seed), [], np.zeros(0, np.int64)
        flat = self.flat()  # parameters, gradients and their means lie in one array each
        self.p, slope, work = self._views(flat), np.zeros_like(flat), np.empty_like(flat)
        g, m, s = self._views(slope), np.zeros_like(flat), np.zeros_like(flat)
        for t in range(1, steps + 1 if len(raw) else 1):
            while len(queue) < batch:
                queue = np.concatenate([queue, r.permutation(len(raw))])
            own, queue = raw[queue[:batch]], queue[batch:]
            target = own[:, WIDTH + 1 - STEP :].ravel()
            real = target >= 0
            target = np.where(real, target, 0)
            _, loss = self.gradients(vocabulary.inputs(own[:, :-1]), vocabulary.head[target], vocabulary.member[target], real, g)
            losses.append(loss)
            lr = min(1, t / 50) * (rates[0] + (rates[1] - rates[0]) * t / steps)
            # m and s are the sums of 0.9^i and 0.995^i times the last gradients and their squares: ten times and 200 times Adam's means
            for a in range(0, len(flat), ADAM_RUN):
                i = slice(a, a + ADAM_RUN)
                d, w = slope[i], work[i]
                m[i] *= 0.9
                m[i] += d
                s[i] *= 0.995
                s[i] += np.multiply(d, d, out=d)
                np.sqrt(s[i], out=w)
                w *= (0.005 / (1 - 0.995**t)) ** 0.5
                w += 1e-8
                np.divide(m[i], w, out=w)
                w *= lr * 0.1 / (1 - 0.9**t)
                flat[i] -= w
        return losses

    def score(self, ids: np.ndarray, sizes: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
        """log10 probability of each text; ids: the texts' ids one after the other."""
        raw, scored = windows(ids, sizes)
        x, f = vocabulary.inputs(raw[:, :-1]), self.folded()
        head, each = vocabulary.head[ids], vocabulary.share[ids] * np.log(10)
        tails: list[tuple[np.ndarray, np.ndarray]] = []
        for a in range(0, len(raw), BATCH):
            z = self.hidden(x[a : a + BATCH], f)
            at = scored[a : a + BATCH].ravel()
            logits, target = z @ self.p["U"], np.where(at >= 0, head[at], 0)
            own = logits[np.arange(len(at)), target]
            own -= _log_sum(logits, f["u"] * np.sqrt((z * z).sum(1).max()))
            real = np.flatnonzero(at >= 0)
            each[at[real]] += own[real]
            tail = np.flatnonzero(target >= HEAD)
            tails.append((z[tail], at[tail]))
        if tails:
            z, at = np.concatenate([z for z, _ in tails]), np.concatenate([at for _, at in tails])
            for group, i in _by_group(head[at] - HEAD):
                logits = z[i] @ self.p["T"][group]
                own = logits[np.arange(len(i)), vocabulary.member[ids[at[i]]]]
                each[at[i]] += own - _log_sum(logits)
        each /= np.log(10)
        ends = np.concatenate(([0.0], np.cumsum(each)))
        edges = np.concatenate(([0], np.cumsum(sizes)))
        return ends[edges[1:]] - ends[edges[:-1]]


def _log_share(n: np.ndarray) -> np.ndarray:
    return np.log((n + 1) / (n + 1).sum(-1, keepdims=True)).astype(np.float32)
