"""Linear-chain conditional random field over dense features: training, marginals, Viterbi."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Positions of a padded batch.
BATCH_POSITIONS = 50_000


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(values - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def batches(lengths: np.ndarray, positions: int = BATCH_POSITIONS):
    """Sequence numbers in batches of similar length; empty sequences are left out."""
    order = [n for n in np.argsort(lengths, kind="stable").tolist() if lengths[n]]
    start = 0
    while start < len(order):
        stop = start + 1
        while stop < len(order) and (stop + 1 - start) * lengths[order[stop]] <= positions:
            stop += 1
        yield order[start:stop]
        start = stop


@dataclass
class Chain:
    weights: np.ndarray  # features x labels
    moves: np.ndarray  # label before x label
    first: np.ndarray  # label

    def _scores(self, sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.array([len(s) for s in sequences])
        scores = np.zeros((len(sequences), lengths.max(), len(self.first)))
        for n, s in enumerate(sequences):
            scores[n, :len(s)] = s @ self.weights
        return scores, lengths

    def _forward_backward(self, scores: np.ndarray, lengths: np.ndarray):
        size, longest, _ = scores.shape
        forward, backward = np.empty_like(scores), np.zeros_like(scores)
        forward[:, 0] = self.first + scores[:, 0]
        for t in range(1, longest):
            step = _log_sum(forward[:, t - 1, :, None] + self.moves, 1) + scores[:, t]
            forward[:, t] = np.where((t < lengths)[:, None], step, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            step = _log_sum(self.moves + (scores[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where((t + 1 < lengths)[:, None], step, 0.0)
        return forward, backward, _log_sum(forward[:, -1], 1)

    def marginals(self, sequences: list[np.ndarray]) -> list[np.ndarray]:
        """Per sequence: positions x labels, each row a distribution."""
        out: list[np.ndarray] = [np.zeros((0, len(self.first)))] * len(sequences)
        for part in batches(np.array([len(s) for s in sequences], dtype=np.int64)):
            scores, lengths = self._scores([sequences[n] for n in part])
            forward, backward, total = self._forward_backward(scores, lengths)
            both = np.exp(forward + backward - total[:, None, None])
            for k, n in enumerate(part):
                out[n] = both[k, :lengths[k]] / both[k, :lengths[k]].sum(axis=1, keepdims=True)
        return out

    def viterbi(self, sequences: list[np.ndarray]) -> list[np.ndarray]:
        """Per sequence: the most probable labels; the lower label on ties."""
        out: list[np.ndarray] = [np.zeros(0, dtype=np.int64)] * len(sequences)
        for part in batches(np.array([len(s) for s in sequences], dtype=np.int64)):
            scores, lengths = self._scores([sequences[n] for n in part])
            best = self.first + scores[:, 0]
            back = np.zeros(scores.shape, dtype=np.int8)
            for t in range(1, scores.shape[1]):
                step = best[:, :, None] + self.moves
                back[:, t] = step.argmax(axis=1)
                best = np.where((t < lengths)[:, None], step.max(axis=1) + scores[:, t], best)
            for k, n in enumerate(part):
                path = np.empty(lengths[k], dtype=np.int64)
                path[-1] = best[k].argmax()
                for t in range(lengths[k] - 1, 0, -1):
                    path[t - 1] = back[k, t, path[t]]
                out[n] = path
        return out


def train(sequences: list[np.ndarray], labels: list[np.ndarray], n_labels: int = 2, rounds: int = 30,
          rate: float = 0.05, decay: float = 1e-4, seed: int = 7) -> Chain:
    """Maximise the penalised likelihood by Adam over batches of sequences; empty input gives zero weights."""
    used = [n for n, s in enumerate(sequences) if len(s)]
    width = sequences[used[0]].shape[1] if used else 0
    chain = Chain(np.zeros((width, n_labels)), np.zeros((n_labels, n_labels)), np.zeros(n_labels))
    parts = list(batches(np.array([len(s) for s in sequences], dtype=np.int64), 4000))
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in (chain.weights, chain.moves, chain.first)]
    shuffled, step = np.random.default_rng(seed), 0
    for turn in range(rounds):
        for b in shuffled.permutation(len(parts)):
            xs, ys = [sequences[n] for n in parts[b]], [labels[n] for n in parts[b]]
            scores, lengths = chain._scores(xs)
            forward, backward, total = chain._forward_backward(scores, lengths)
            places = lengths.sum()
            rest = np.concatenate([np.eye(n_labels)[y] - np.exp(f[:len(y)] + g[:len(y)] - z)
                                   for y, f, g, z in zip(ys, forward, backward, total)])
            moves = np.zeros_like(chain.moves)
            for t in range(1, scores.shape[1]):
                live = t < lengths
                joint = np.exp(forward[live, t - 1, :, None] + chain.moves
                               + (scores[live, t] + backward[live, t])[:, None, :] - total[live, None, None])
                moves -= joint.sum(axis=0)
            for y in ys:
                np.add.at(moves, (y[:-1], y[1:]), 1)
            starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            step += 1
            for value, gradient, (mean, square) in zip(
                    (chain.weights, chain.moves, chain.first),
                    (np.concatenate(xs).T @ rest, moves, rest[starts].sum(axis=0)), state):
                gradient = gradient / places - decay * value
                mean += 0.1 * (gradient - mean)
                square += 0.001 * (gradient ** 2 - square)
                value += rate * (1 - turn / rounds) * (mean / (1 - 0.9 ** step)) / (
                    np.sqrt(square / (1 - 0.999 ** step)) + 1e-8)
    return chain
