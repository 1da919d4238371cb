"""A recurrent network over runs of amounts, trained by gradients that the tasks add up.

The network is a stack of long short-term memory layers and a linear unit on the last state. Each evaluation of loss and
gradient is one pass over the written table of runs: a task unrolls the network over its Arrow batches, propagates back
through time, and gives one gradient, summed. Only the weights go out, and sums of gradients come back, at most
``SUMS_AT_ONCE`` to a task or to the driver. The driver takes limited-memory quasi-Newton steps and stops when the loss on
customers that the fit leaves aside no longer falls.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.functions.shipping import ship

ship(__name__)

#: Passes over the runs at most, and passes without a better loss on the customers left aside before the fit ends.
MOST_PASSES, PATIENCE = 80, 8

#: Pairs of steps and gradient changes that the quasi-Newton step remembers.
MEMORY = 10

#: Sums of gradients that meet in one task, or on the driver.
SUMS_AT_ONCE = 64

#: Rows that the network takes at a time.
ROWS_AT_ONCE = 500

#: The error up to which the Huber loss is quadratic.
DELTA = 1.0


def _logistic(x: np.ndarray) -> np.ndarray:
    """In place. An exponential costs half of what numpy's tanh does, and tanh x is 2 logistic(2 x) - 1."""
    np.negative(x, out=x)
    with np.errstate(over="ignore"):
        np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


@dataclass(frozen=True)
class Network:
    """The shape of the network. Weights are one flat vector: for each layer a matrix (inputs and state and 1, 4 x hidden)
    for the input, forget, output and candidate gates, then the linear unit."""

    hidden: int = 8
    layers: int = 2

    def shapes(self) -> list[tuple[int, int]]:
        inputs = [1, *[self.hidden] * (self.layers - 1)]
        return [*[(i + self.hidden + 1, 4 * self.hidden) for i in inputs], (self.hidden + 1, 1)]

    def split(self, weights: np.ndarray) -> list[np.ndarray]:
        parts, at = [], 0
        for rows, columns in self.shapes():
            parts.append(weights[at:at + rows * columns].reshape(rows, columns))
            at += rows * columns
        return parts

    def start(self, seed: int = 11) -> np.ndarray:
        """Uniform weights by the number of inputs and outputs, biases of 0 but for the forget gates, which start open."""
        rng, parts = np.random.default_rng(seed), []
        for rows, columns in self.shapes():
            bound = np.sqrt(6 / (rows - 1 + columns))
            part = rng.uniform(-bound, bound, (rows, columns))
            part[-1] = 0
            if columns > 1:
                part[-1, self.hidden:2 * self.hidden] = 1
            parts.append(part.ravel())
        return np.concatenate(parts)

    def _bent(self, matrix: np.ndarray, joined: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The gates and the candidates (cells, rows) of a step: logistic and tanh, all by one exponential."""
        gates = 3 * self.hidden
        z = _logistic((matrix * np.repeat([1.0, 2.0], [gates, self.hidden])).T @ joined)
        z[gates:] *= 2
        z[gates:] -= 1
        return z[:gates], z[gates:]

    def forward(self, weights: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, list]:
        """Predictions for runs (rows, steps), and per layer and step what the way back needs.

        Inside, a row is a column: the values of a gate lie side by side, which numpy takes in one go.
        """
        *layers, out = self.split(weights)
        h, rows = self.hidden, len(x)
        inputs, kept = list(np.ascontiguousarray(x.T)[:, None, :]), []
        for matrix in layers:
            state = cell = np.zeros((h, rows))
            steps, outputs = [], []
            for value in inputs:
                joined = np.concatenate([value, state, np.ones((1, rows))])
                gates, candidate = self._bent(matrix, joined)
                before = cell
                cell = gates[h:2 * h] * before + gates[:h] * candidate
                bent = _logistic(2 * cell)
                bent *= 2
                bent -= 1
                state = gates[2 * h:] * bent
                steps.append((joined, gates, candidate, before, bent))
                outputs.append(state)
            kept.append(steps)
            inputs = outputs
        return out[:-1, 0] @ inputs[-1] + out[-1, 0], kept

    def loss_and_gradient(self, weights: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
        """The sum of the Huber losses of all rows, and its gradient; so many rows at a time as a cache holds."""
        loss, gradient = 0.0, np.zeros(len(weights))
        for at in range(0, len(x), ROWS_AT_ONCE):
            part, slopes = self._loss_and_gradient(weights, x[at:at + ROWS_AT_ONCE], y[at:at + ROWS_AT_ONCE])
            loss += part
            gradient += slopes
        return loss, gradient

    def _loss_and_gradient(self, weights: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
        *layers, out = self.split(weights)
        h, rows = self.hidden, len(x)
        predicted, kept = self.forward(weights, x)
        error = predicted - y
        slope = np.clip(error, -DELTA, DELTA)
        gradients = [np.zeros_like(m) for m in layers]
        # The last state of a layer is its output gate times its bent cell.
        last = kept[-1][-1][1][2 * h:] * kept[-1][-1][4]
        out_gradient = np.append(last @ slope, slope.sum())
        above = [np.zeros((h, rows)) for _ in range(x.shape[1])]
        above[-1] = out[:-1] * slope
        for matrix, steps, gradient in zip(reversed(layers), reversed(kept), reversed(gradients)):
            below, d_state, d_cell = [], np.zeros((h, rows)), np.zeros((h, rows))
            for (joined, gates, candidate, before, bent), from_above in zip(reversed(steps), reversed(above)):
                d_state = d_state + from_above
                entry, forget, release = gates[:h], gates[h:2 * h], gates[2 * h:]
                d_cell = d_cell + d_state * release * (1 - bent * bent)
                d_z = np.empty((4 * h, rows))
                np.multiply(d_cell, candidate, out=d_z[:h])
                np.multiply(d_cell, before, out=d_z[h:2 * h])
                np.multiply(d_state, bent, out=d_z[2 * h:3 * h])
                d_z[:3 * h] *= gates * (1 - gates)
                np.multiply(d_cell * entry, 1 - candidate * candidate, out=d_z[3 * h:])
                gradient += joined @ d_z.T
                d_joined = matrix @ d_z
                inputs = len(joined) - h - 1
                below.append(d_joined[:inputs])
                d_state, d_cell = d_joined[inputs:inputs + h], d_cell * forget
            above = below[::-1]
        return huber(error), np.concatenate([*[g.ravel() for g in gradients], out_gradient])


def huber(error: np.ndarray) -> float:
    size = np.abs(error)
    return float(np.where(size <= DELTA, 0.5 * size**2, DELTA * (size - 0.5 * DELTA)).sum())


@dataclass
class Sums:
    """Loss and number of rows of the fit and of the customers left aside, and the gradient of the former's mean."""

    loss: float
    aside: float
    gradient: np.ndarray


def _matrix(batch: pa.RecordBatch, columns: int) -> np.ndarray:
    return np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(columns)])


def _pack(totals: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([totals.tobytes()], pa.binary())], names=["sums"])


def _add_up(batches):
    total = None
    for batch in batches:
        for value in batch.column(0):
            part = np.frombuffer(value.as_py())
            total = part if total is None else total + part
    if total is not None:
        yield _pack(total)


def evaluate(runs: DataFrame, network: Network, weights: np.ndarray, parts: int) -> Sums:
    """One pass over ``runs`` (amounts, the next amount, whether left aside), a written table of ``parts`` partitions."""

    def of_batches(batches):
        total = np.zeros(len(weights) + 4)
        for batch in batches:
            columns = batch.num_columns - 2
            x, y = 2 * _matrix(batch, columns) - 1, batch.column(columns).to_numpy(zero_copy_only=False)
            aside = batch.column(columns + 1).to_numpy(zero_copy_only=False).astype(bool)
            if (~aside).any():
                loss, gradient = network.loss_and_gradient(weights, x[~aside], y[~aside])
                total[0] += loss
                total[4:] += gradient
            if aside.any():
                total[2] += huber(network.forward(weights, x[aside])[0] - y[aside])
            total[1] += (~aside).sum()
            total[3] += aside.sum()
        yield _pack(total)

    sums = runs.mapInArrow(of_batches, "sums binary")
    while parts > SUMS_AT_ONCE:
        parts = -(-parts // SUMS_AT_ONCE)
        sums = sums.repartition(parts).mapInArrow(_add_up, "sums binary")
    total = sum((np.frombuffer(r["sums"]) for r in sums.collect()), np.zeros(len(weights) + 4))
    loss, rows, aside, rows_aside = total[:4]
    rows = max(rows, 1)
    # Without customers left aside the fit is judged by its own loss.
    return Sums(loss / rows, aside / rows_aside if rows_aside else loss / rows, total[4:] / rows)


@dataclass
class _Steps:
    """Limited-memory quasi-Newton directions."""

    moves: list = field(default_factory=list)

    def direction(self, gradient: np.ndarray) -> np.ndarray:
        q, used = gradient.copy(), []
        for move, change in reversed(self.moves):
            a = (move @ q) / (move @ change)
            q -= a * change
            used.append(a)
        if self.moves:
            move, change = self.moves[-1]
            q *= (move @ change) / (change @ change)
        else:
            q *= min(1.0, 1.0 / max(np.abs(gradient).sum(), 1e-12))
        for (move, change), a in zip(self.moves, reversed(used)):
            q += (a - (change @ q) / (move @ change)) * move
        return -q

    def add(self, move: np.ndarray, change: np.ndarray) -> None:
        if move @ change > 1e-12:
            self.moves = [*self.moves, (move, change)][-MEMORY:]


def fit(runs: DataFrame, network: Network, parts: int) -> np.ndarray:
    """The weights with the least loss on the customers left aside, of all that the steps came by."""
    weights = network.start()
    now, steps = evaluate(runs, network, weights, parts), _Steps()
    best, best_weights, waited, length = now.aside, weights, 0, 1.0
    for _ in range(MOST_PASSES - 1):
        direction = steps.direction(now.gradient)
        slope = direction @ now.gradient
        if slope > -1e-14:
            break
        ahead = evaluate(runs, network, weights + length * direction, parts)
        if not ahead.loss <= now.loss + 1e-4 * length * slope:
            # Too far: half the way, from the same place.
            length /= 2
            waited += 1
            if length < 1e-4 or waited >= 2 * PATIENCE:
                break
            continue
        steps.add(length * direction, ahead.gradient - now.gradient)
        weights, now, length = weights + length * direction, ahead, 1.0
        if now.aside < best * (1 - 1e-4):
            best, best_weights, waited = now.aside, weights, 0
        else:
            waited += 1
            if waited >= PATIENCE:
                break
    return best_weights


def with_prediction(rows: DataFrame, columns: list[str], network: Network, weights: np.ndarray) -> DataFrame:
    """``rows`` with ``prediction``, null where one of ``columns`` is."""
    names = rows.columns
    schema = rows.select("*", F.lit(None).cast("double").alias("prediction")).schema

    def of_batches(batches):
        for batch in batches:
            values = [batch.column(names.index(c)) for c in columns]
            x = np.column_stack([v.to_numpy(zero_copy_only=False).astype(float) for v in values])
            known = ~np.isnan(x).any(axis=1)
            found = np.full(len(x), np.nan)
            if known.any():
                found[known] = network.forward(weights, 2 * x[known] - 1)[0]
            prediction = pa.array(found, pa.float64(), from_pandas=True)
            yield pa.RecordBatch.from_arrays([*batch.columns, prediction], names=[*names, "prediction"])

    return rows.mapInArrow(of_batches, schema)
