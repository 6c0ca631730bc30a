"""A small causal self-attention model over subword ids, in numpy.

Words are cut by a public byte-level BPE; the last piece of a word is an id of its own, so that
words are told apart without blanks and word probabilities sum to at most 1. Pieces outside
the model's vocabulary are spelled in bytes.

A position attends to itself and to the positions before it in its window and text, with a
learned bias for each distance. Windows hold ``STEP`` new positions behind ``STEP`` that only
give context; every position is scored in one window. Texts begin at a window's edge (``aligned``),
so that a text's score does not depend on its neighbours. What attention gathers is added to
vectors for the last two pieces; the next id is predicted by its class and then within it.
"""

from dataclasses import dataclass

import numpy as np

#: Classes, and ids of a class.
CLASSES, MEMBERS = 64, 32
VOCABULARY = CLASSES * MEMBERS
WIDTH = 32
#: New positions of a window; as many before them are context.
STEP = 128
#: Positions that are scored at once.
STRETCH = 256 * STEP
#: The two ids that are no pieces; the inner and the final bytes follow.
BEGIN, END, FIRST_BYTE = 0, 1, 2
NAMES = ("query", "key", "value", "last", "before", "classes", "class_bias", "members", "member_bias", "distance")


def byte_ids(piece: bytes, final: bool) -> list[int]:
    """A piece spelled in bytes, of which the last may end the word."""
    ids = [FIRST_BYTE + b for b in piece]
    if final:
        ids[-1] += 256
    return ids


class Speller:
    """Ids of a word; ``known`` maps (piece, final) to an id above the bytes'."""

    def __init__(self, encode, piece_bytes, known: dict[tuple[int, bool], int]):
        self.encode, self.piece_bytes, self.known = encode, piece_bytes, known
        # Ids that pieces have had so far, by 2 * piece + final.
        self.starts, self.lengths = np.zeros((2, 0), np.int64)
        self.ids = np.empty(0, np.int64)

    def ids_of(self, piece: int, final: bool) -> list[int]:
        one = self.known.get((piece, final))
        return byte_ids(self.piece_bytes(piece), final) if one is None else [one]

    def __call__(self, word: bytes) -> list[int]:
        pieces = self.encode(word.decode("utf-8", "replace"))
        return [i for at, piece in enumerate(pieces) for i in self.ids_of(piece, at == len(pieces) - 1)]

    def spelled(self, pieces: np.ndarray, final: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces in a row, and how many each has."""
        codes = 2 * pieces + final
        more = int(codes.max(initial=-1)) + 1 - len(self.lengths)
        if more > 0:
            self.starts, self.lengths = np.pad(self.starts, (0, more)), np.pad(self.lengths, (0, more))
        new = np.unique(codes[self.lengths.take(codes) == 0])
        found = [self.ids_of(*divmod(code, 2)) for code in new.tolist()]
        self.lengths[new] = np.fromiter(map(len, found), np.int64, len(found))
        self.starts[new] = len(self.ids) + np.cumsum(self.lengths[new]) - self.lengths[new]
        self.ids = np.concatenate([self.ids, *(np.array(ids, np.int64) for ids in found)])
        return ragged(self.ids, self.starts.take(codes), self.lengths.take(codes))


def ragged(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of the values in a row, and their lengths."""
    shift = starts - (np.cumsum(lengths) - lengths)
    return values.take(np.arange(int(lengths.sum())) + np.repeat(shift, lengths)), lengths


@dataclass
class Model:
    """Parameters; ``place`` maps an id to its slot, ``class * MEMBERS + member``."""

    place: np.ndarray
    tables: dict[str, np.ndarray]

    def __getattr__(self, name):
        if name in NAMES:
            return self.tables[name]
        raise AttributeError(name)


def fresh_model(counts: np.ndarray, follow: np.ndarray, seed: int = 5) -> Model:
    """An untrained model. Classes hold ids that follow alike ids, biases the id shares.

    ``counts``: how often each id is predicted; ``follow``: counts by id before and id.
    """
    share = np.sqrt(follow + 0.0) / np.sqrt(np.maximum(follow.sum(axis=0), 1.0))
    axis = np.random.default_rng(seed).normal(size=VOCABULARY)
    for _ in range(12):  # second singular direction, by power steps without the first
        axis -= axis.mean()
        axis = share.T @ (share @ axis)
        axis /= np.linalg.norm(axis) + 1e-12
    place = np.empty(VOCABULARY, np.int64)
    place[np.lexsort((counts, axis))] = np.arange(VOCABULARY)
    shares = np.empty(VOCABULARY)
    shares[place] = (counts + 0.1) / (counts + 0.1).sum()
    by_class = shares.reshape(CLASSES, MEMBERS)
    draw = np.random.default_rng(seed + 1)
    small = lambda *shape: draw.normal(scale=0.1, size=shape).astype(np.float32)
    return Model(
        place,
        {
            "query": small(VOCABULARY, WIDTH),
            "key": small(VOCABULARY, WIDTH),
            "value": small(VOCABULARY, WIDTH),
            "last": small(VOCABULARY, WIDTH),
            "before": small(VOCABULARY, WIDTH),
            "classes": small(CLASSES, WIDTH),
            "class_bias": np.log(by_class.sum(axis=1)).astype(np.float32),
            "members": small(CLASSES, MEMBERS, WIDTH),
            "member_bias": np.log(by_class / by_class.sum(axis=1, keepdims=True)).astype(np.float32),
            "distance": np.zeros(2 * STEP, np.float32),
        },
    )


_NEW = np.arange(STEP)[:, None] + STEP
_OLD = np.arange(2 * STEP)[None, :]
_DISTANCE = np.clip(_NEW - _OLD, 0, 2 * STEP - 1)
_CAUSAL = _OLD <= _NEW


#: Windows that are worked on together, so that their weights stay in a core's cache.
TOGETHER = 4
#: A window's positions go by halves: the first half sees nothing of the second, and products of this size take
#: BLAS half the time a position that products of whole windows do.
HALVES = (slice(0, STEP // 2), slice(STEP // 2, STEP))
#: Below this size of any score, exponentials need no shift.
TAME = 40.0
#: Not seen; its exponential is 0.
HIDDEN = np.float32(-1e9)
#: Positions whose next ids are predicted together.
PREDICTED = 4096
#: Parameters that a step works on together.
PIECE = 32_768
#: Rows of a block of a product.
BLOCKED = 256
#: Rows of one id up to which sums are made for all ids at once, row by row.
FEW = 8


def _overlapping(values: np.ndarray, blank: int) -> np.ndarray:
    """By window the ``STEP`` values before it and its own, as a view; blanks stand before the first."""
    values = np.concatenate([np.full(STEP, blank, values.dtype), values])
    step = values.strides[0]
    shape = (len(values) // STEP - 1, 2 * STEP)
    return np.lib.stride_tricks.as_strided(values, shape, (STEP * step, step), writeable=False)


def _windows(model: Model, texts: np.ndarray):
    """Windows that are worked on together, the first of their old rows that is seen, and by half what is added to scores.

    That is the distance's bias, and ``HIDDEN`` where nothing is seen, by old row and position.
    Most windows are of one text, with or without it before them, and share tables; where a text begins, nothing
    before the window is worked on.
    """
    whole = np.where(_CAUSAL, model.distance[_DISTANCE], HIDDEN).T
    own, around = texts.reshape(-1, STEP), _overlapping(texts, -2)
    plain = ((own[:, 1:] == own[:, :-1]) | (own[:, 1:] == -1)).all(axis=1)
    same = around[:, :STEP] == own[:, :1]
    begins, follows = plain & ~same.any(axis=1), plain & same.all(axis=1)
    for chosen, first in ((begins, STEP), (follows, 0), (~(begins | follows), 0)):
        biases = [np.ascontiguousarray(whole[first : STEP + half.stop, half]) for half in HALVES]
        windows = np.flatnonzero(chosen)
        for at in range(0, len(windows), TOGETHER):
            part = windows[at : at + TOGETHER]
            if plain[part[0]] and (first or follows[part[0]]):
                yield part, first, biases
            else:
                yield part, first, [
                    np.where(around[part, : STEP + half.stop, None] == own[part, None, half], bias, HIDDEN)
                    for half, bias in zip(HALVES, biases, strict=True)
                ]


def _attend(model: Model, ids: np.ndarray, texts: np.ndarray, keep: bool = False):
    """What attention gathers per position, the sums of its exponentials, and what gradients need (``keep``).

    This is, for windows that were worked on together: their numbers, the first old row that is seen, key rows, value
    rows with a column of ones, and by half the scaled query rows and the exponentials of scores by old row and position.
    """
    queries = model.query * np.float32(WIDTH**-0.5)
    ones = np.concatenate([model.value, np.ones((VOCABULARY, 1), model.value.dtype)], axis=1)
    by_window, around = ids.reshape(-1, STEP), _overlapping(ids, BEGIN)
    longest = lambda rows: np.einsum("ij,ij->i", rows, rows).max(initial=0) ** 0.5
    tame = longest(queries) * longest(model.key) + np.abs(model.distance).max() < TAME
    gathered = np.empty((*by_window.shape, WIDTH + 1), model.query.dtype)
    held = []
    room = None if keep else np.empty((TOGETHER, 2 * STEP, STEP // 2), model.query.dtype)
    for part, first, biases in _windows(model, texts):
        old = around[part, first:]
        keys, values = model.key.take(old, axis=0), ones.take(old, axis=0)
        halves = []
        for half, bias in zip(HALVES, biases, strict=True):
            seen = STEP - first + half.stop
            query = queries.take(by_window[part, half], axis=0)
            shape = (len(part), seen, STEP // 2)
            weight = np.empty(shape, query.dtype) if keep else room[: len(part), :seen]
            np.matmul(keys[:, :seen], np.ascontiguousarray(query.transpose(0, 2, 1)), out=weight)
            weight += bias
            if not tame:
                weight -= weight.max(axis=1, keepdims=True)
            np.exp(weight, out=weight)
            gathered[part, half] = weight.transpose(0, 2, 1) @ values[:, :seen]
            halves.append((query, weight))
        if keep:
            held.append((part, first, keys, values, halves))
    gathered = gathered.reshape(-1, WIDTH + 1)
    total = gathered[:, WIDTH:]  # the ones' column
    return gathered[:, :WIDTH] / total, total, held


def _product(rows: np.ndarray, table: np.ndarray) -> np.ndarray:
    """``rows @ table``, in blocks of a size that BLAS does not pack."""
    out = np.empty((len(rows), table.shape[1]), rows.dtype)
    whole = len(rows) // BLOCKED * BLOCKED
    blocks = lambda x: x[:whole].reshape(-1, BLOCKED, x.shape[1])
    np.matmul(blocks(rows), table, out=blocks(out))
    np.matmul(rows[whole:], table, out=out[whole:])
    return out


class Prediction:
    """Of some positions (``rows``), put in the order of the class of the wanted id: exponentials and their sums, by class
    and within the class."""

    def __init__(self, model: Model, state: np.ndarray, wanted: np.ndarray, rows: np.ndarray):
        place = model.place.take(wanted.take(rows))
        group = place // MEMBERS
        self.model, each = model, np.arange(len(place))
        order = np.argsort(group.astype(np.int16), kind="stable")  # a radix sort
        self.rows, self.group = rows.take(order), group.take(order)
        self.state = state.take(self.rows, axis=0)
        ends = np.cumsum(np.bincount(group, minlength=CLASSES)).tolist()
        self.spans = [(c, a, b) for c, (a, b) in enumerate(zip([0, *ends[:-1]], ends, strict=True)) if a < b]
        # Where the wanted class and member stand among a position's.
        self.slots = each * CLASSES + self.group, each * MEMBERS + place.take(order) % MEMBERS
        self.parts = self._scores()
        self.found = sum(part.ravel().take(slots) for part, slots in zip(self.parts, self.slots, strict=True))
        self.shift = np.zeros(len(place), state.dtype)
        self.totals = self._exponentials()
        if any(((x < 1e-30) | (x > 1e30) | np.isnan(x)).any() for x in self.totals):  # the scores are large
            self.parts = self._scores()
            for part in self.parts:
                largest = part.max(axis=1, keepdims=True)
                part -= largest
                self.shift += largest[:, 0]
            self.totals = self._exponentials()

    def _scores(self) -> tuple[np.ndarray, np.ndarray]:
        model, state = self.model, self.state
        classes = _product(state, np.ascontiguousarray(model.classes.T))
        classes += model.class_bias
        members = np.empty((len(state), MEMBERS), state.dtype)
        columns = np.ascontiguousarray(model.members.transpose(0, 2, 1))
        for c, a, b in self.spans:
            np.dot(state[a:b], columns[c], out=members[a:b])
        members += model.member_bias.take(self.group, axis=0)
        return classes, members

    def _exponentials(self) -> list[np.ndarray]:
        with np.errstate(over="ignore"):
            return [np.exp(part, out=part) @ np.ones(part.shape[1], part.dtype) for part in self.parts]

    def logs(self) -> np.ndarray:
        """Log probabilities of the wanted ids, in the order of ``rows``."""
        return self.found - self.shift - np.log(self.totals[0]) - np.log(self.totals[1])

    def gradients(self) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """Those of the mean loss: for the states, in the order of ``rows``, and by table. Exponentials give way to errors."""
        model, state, n = self.model, self.state, max(len(self.found), 1)
        share = state.dtype.type(1 / n)
        for part, total, slots in zip(self.parts, self.totals, self.slots, strict=True):
            part *= (share / total)[:, None]
            part.reshape(-1)[slots] -= share
        of_class, of_member = self.parts
        members, member_bias = np.zeros_like(model.members), np.zeros_like(model.member_bias)
        back = _product(of_class, model.classes)
        inner = np.empty_like(state)
        for c, a, b in self.spans:
            np.dot(of_member[a:b].T, state[a:b], out=members[c])
            np.add.reduce(of_member[a:b], axis=0, out=member_bias[c])
            np.dot(of_member[a:b], model.members[c], out=inner[a:b])
        back += inner
        whole = len(state) // BLOCKED * BLOCKED
        blocks = lambda x: x[:whole].reshape(-1, BLOCKED, x.shape[1])
        classes = (blocks(of_class).transpose(0, 2, 1) @ blocks(state)).sum(axis=0)
        classes += of_class[whole:].T @ state[whole:]
        return back, {
            "classes": classes,
            "class_bias": of_class.sum(axis=0),
            "members": members,
            "member_bias": member_bias,
        }


def _before(ids: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """The id before each position, that of the beginning where there is none."""
    before = np.concatenate([[BEGIN], ids[:-1]])
    before[np.concatenate([[True], texts[1:] != texts[:-1]])] = BEGIN
    return before


def _padded(ids: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    more = -len(ids) % STEP
    return np.pad(ids, (0, more)), np.pad(texts, (0, more), constant_values=-1)


def aligned(lengths: np.ndarray) -> tuple[np.ndarray, int]:
    """Where the ids of texts stand if each text begins at a window's edge, and the length of it all."""
    whole = -(-lengths // STEP) * STEP
    shift = np.cumsum(whole) - whole - (np.cumsum(lengths) - lengths)
    return np.arange(int(lengths.sum())) + np.repeat(shift, lengths), int(whole.sum())


def spread(values: np.ndarray, at: np.ndarray, n: int, blank: int) -> np.ndarray:
    """The values at their places among ``n``, others blank."""
    out = np.full(n, blank, np.int64)
    out[at] = values
    return out


def text_log_likelihoods(model: Model, ids: np.ndarray, texts: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """As ``log_likelihoods``, each text by itself; texts are numbered from 0 in order."""
    at, n = aligned(np.bincount(texts))
    return log_likelihoods(model, spread(ids, at, n, BEGIN), spread(texts, at, n, -1), spread(wanted, at, n, BEGIN))[at]


def log_likelihoods(model: Model, ids: np.ndarray, texts: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Natural log probability of ``wanted``, the id after each position.

    Worked on in stretches that begin a window's context early, so that memory is bounded and
    every position is scored in the same window as without them.
    """
    out = np.empty(len(ids), np.float32)
    for at in range(0, len(ids), STRETCH):
        part = slice(max(at - STEP, 0), at + STRETCH)
        out[at : at + STRETCH] = _stretch(model, ids[part], texts[part], wanted[part], at - part.start)
    return out


def _stretch(model: Model, ids: np.ndarray, texts: np.ndarray, wanted: np.ndarray, context: int) -> np.ndarray:
    """As ``log_likelihoods``, without the first positions, which only give context."""
    n = len(ids)
    padded, marks = _padded(ids, texts)
    state = _attend(model, padded, marks)[0][:n]
    state += model.last.take(ids, axis=0)
    state += model.before.take(_before(ids, texts), axis=0)
    out = np.empty(n, state.dtype)
    for at in range(context, n, PREDICTED):
        predicted = Prediction(model, state, wanted, np.arange(at, min(at + PREDICTED, n)))
        out[predicted.rows] = predicted.logs()
    return out[context:]


def _added(rows: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Rows summed by id: an id of many rows by itself, the others together by their first rows, their second ones and so on."""
    out = np.zeros((VOCABULARY, rows.shape[1]), rows.dtype)
    order = np.argsort(ids.astype(np.int16), kind="stable")  # a radix sort
    rows, ids = rows.take(order, axis=0), ids[order]
    starts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]])) if len(ids) else np.empty(0, np.int64)
    counts = np.diff(np.append(starts, len(ids)))
    by_count = np.argsort(-counts, kind="stable")
    starts, counts = starts[by_count], counts[by_count]
    many = int(np.searchsorted(-counts, -FEW))
    for at, n in zip(starts[:many].tolist(), counts[:many].tolist(), strict=True):
        np.add.reduce(rows[at : at + n], axis=0, out=out[ids[at]])
    starts, counts = starts[many:], counts[many:]
    sums = rows.take(starts, axis=0)
    for at in range(1, int(counts.max(initial=0))):
        more = int(np.searchsorted(-counts, -at))  # have another row
        sums[:more] += rows.take(starts[:more] + at, axis=0)
    out[ids[starts]] = sums
    return out


def gradients(model: Model, ids: np.ndarray, texts: np.ndarray, wanted: np.ndarray):
    """Mean loss and its gradients by table name; positions of no text (-1) count for nothing."""
    ids, texts = _padded(ids, texts)
    real = np.flatnonzero(texts >= 0)
    gathered, total, held = _attend(model, ids, texts, keep=True)
    state = gathered + model.last.take(ids, axis=0)
    state += model.before.take(_before(ids, texts), axis=0)
    predicted = Prediction(model, state, wanted, real)
    loss = -predicted.logs().sum() / max(len(real), 1)
    own_back, grads = predicted.gradients()
    # By position, with a window before the first: what its query, its key and its value, and what it adds to the states
    # of its own and of the next position.
    rows = np.zeros((STEP + len(ids), 5 * WIDTH), gathered.dtype)
    d_query, d_old, back, d_next = np.split(rows, [WIDTH, 3 * WIDTH, 4 * WIDTH], axis=1)
    back[STEP + predicted.rows] = own_back
    d_next[:-1] = back[1:]
    begins = STEP + np.flatnonzero(np.concatenate([[True], texts[1:] != texts[:-1]]))
    d_next[begins - 1] = 0
    # Of a row's weights, exponentials over their sum, the gradient is weight * (own part - what all gather).
    with_gathered = np.empty((len(ids), WIDTH + 1), gathered.dtype)
    part = np.divide(back[STEP:], total, out=with_gathered[:, :WIDTH])
    np.negative(np.einsum("ij,ij->i", part, gathered), out=with_gathered[:, WIDTH])
    with_gathered = with_gathered.reshape(-1, STEP, WIDTH + 1)
    d_query = d_query[STEP:].reshape(-1, STEP, WIDTH)
    far = [np.zeros((STEP + half.stop, STEP // 2), gathered.dtype) for half in HALVES]
    for windows, first, keys, values, halves in held:
        for half, of_half, (query, weight) in zip(HALVES, far, halves, strict=True):
            seen = weight.shape[1]
            own = with_gathered[windows, half]
            d_score = values[:, :seen] @ np.ascontiguousarray(own.transpose(0, 2, 1))
            d_score *= weight
            of_half[first:] += d_score.sum(axis=0)
            d_query[windows, half] = d_score.transpose(0, 2, 1) @ keys[:, :seen]
            d_rows = np.empty((len(windows), seen, 2 * WIDTH), weight.dtype)
            np.matmul(d_score, query, out=d_rows[:, :, :WIDTH])
            np.matmul(weight, np.ascontiguousarray(own[:, :, :WIDTH]), out=d_rows[:, :, WIDTH:])
            for at, own_rows in zip((STEP * windows + first).tolist(), d_rows, strict=True):
                d_old[at : at + seen] += own_rows
    distance = np.zeros(2 * STEP)
    for half, of_half in zip(HALVES, far, strict=True):
        distance += np.bincount(_DISTANCE[half, : STEP + half.stop].T.ravel(), of_half.ravel(), minlength=2 * STEP)
    added = np.split(_added(rows[STEP:], ids), 5, axis=1)
    added[0] *= np.float32(WIDTH**-0.5)
    grads |= dict(zip(("query", "key", "value", "last", "before"), added, strict=True)) | {"distance": distance.astype(np.float32)}
    grads["before"][BEGIN] += back[begins].sum(axis=0)
    return loss, grads


class Adam:
    """Steps of Adam on a model, in place; the rate falls to a twentieth over ``steps`` and stays there.

    The model's tables become views of one row of parameters, which is worked on in pieces that stay in a core's
    cache. Moments are held as sums, a tenth and a hundredth of which they are.
    """

    def __init__(self, model: Model, steps: int, rate: float = 0.02):
        self.model, self.steps, self.rate, self.taken = model, steps, rate, 0
        self.values = flat(model)
        model.tables = _tables(self.values, model)
        self.moment, self.square = np.zeros_like(self.values), np.zeros_like(self.values)
        self.gradient = np.empty_like(self.values)
        self.by_table = _tables(self.gradient, model)

    def step(self, ids: np.ndarray, texts: np.ndarray, wanted: np.ndarray) -> None:
        self.taken += 1
        t = self.taken
        for k, g in gradients(self.model, ids, texts, wanted)[1].items():
            self.by_table[k][...] = g
        now = self.rate * max(1 - 0.95 * t / self.steps, 0.05)
        # Of the moments m / (1 - 0.9 ** t) and s / (1 - 0.99 ** t), the step is now * m / (sqrt(s) + 1e-8).
        root = (0.01 / (1 - 0.99**t)) ** 0.5
        scale, least = now * 0.1 / (1 - 0.9**t) / root, 1e-8 / root
        for at in range(0, len(self.values), PIECE):
            value, g, moment, square = (x[at : at + PIECE] for x in (self.values, self.gradient, self.moment, self.square))
            moment *= 0.9
            moment += g
            g *= g
            square *= 0.99
            square += g
            np.sqrt(square, out=g)
            g += least
            np.divide(moment, g, out=g)
            g *= scale
            value -= g


def flat(model: Model) -> np.ndarray:
    return np.concatenate([model.tables[k].ravel() for k in NAMES])


def _tables(values: np.ndarray, like: Model) -> dict[str, np.ndarray]:
    """Views of ``values``, the parameters in a row, by table."""
    tables, at = {}, 0
    for k in NAMES:
        shape, size = like.tables[k].shape, like.tables[k].size
        tables[k], at = values[at : at + size].reshape(shape), at + size
    return tables


def shaped(values: np.ndarray, like: Model) -> Model:
    """The model of which ``values`` are the parameters in a row."""
    return Model(like.place, _tables(values.astype(np.float32), like))
