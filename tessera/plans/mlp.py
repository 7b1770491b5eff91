"""MLP regressor as a distributed job (the one learner Spark lacks).

Training is full-batch gradient descent with Adam. Per step, each partition
computes the summed gradient of the squared loss on its rows in
``mapInArrow`` (a batch's feature arrays are one numpy matrix) and returns one row; the driver sums
P rows of n_params numbers and updates the weights. The cached input is read
once per step. Scoring is native: each unit is a Spark expression over the
feature array, so no Python runs at scoring time.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _shapes(n_in: int, hidden: list[int]) -> list[tuple[int, int]]:
    sizes = [n_in] + list(hidden) + [1]
    return [(sizes[i], sizes[i + 1]) for i in range(len(sizes) - 1)]


def _unflatten(theta: np.ndarray, shapes):
    out, k = [], 0
    for a, b in shapes:
        w = theta[k:k + a * b].reshape(a, b)
        k += a * b
        bias = theta[k:k + b]
        k += b
        out.append((w, bias))
    return out


def _act(z, name):
    return np.maximum(z, 0.0) if name == "relu" else np.tanh(z)


def _act_grad(z, name):
    return (z > 0).astype(float) if name == "relu" else 1.0 - np.tanh(z) ** 2


def _grad_fn(theta_b, shapes, activation):
    def run(batches):
        theta = theta_b.value
        layers = _unflatten(theta, shapes)
        grad = np.zeros_like(theta)
        loss, n = 0.0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            y = batch.column("y").to_numpy(zero_copy_only=False)
            zs, acts = [], [x]
            for i, (w, b) in enumerate(layers):
                z = acts[-1] @ w + b
                zs.append(z)
                acts.append(z if i == len(layers) - 1 else _act(z, activation))
            err = acts[-1][:, 0] - y
            loss += float((err ** 2).sum())
            n += len(y)
            delta = err[:, None]  # d(0.5*err^2)/d(out)
            parts = []
            for i in range(len(layers) - 1, -1, -1):
                parts.append((acts[i].T @ delta, delta.sum(axis=0)))
                if i:
                    delta = (delta @ layers[i][0].T) * _act_grad(zs[i - 1], activation)
            flat = np.concatenate([np.concatenate([gw.ravel(), gb]) for gw, gb in reversed(parts)])
            grad += flat
        yield pa.RecordBatch.from_arrays([pa.array([grad.tolist()], pa.list_(pa.float64())), pa.array([loss], pa.float64()),
                                          pa.array([n], pa.int64())], names=["g", "loss", "n"])
    return run


class MLPRegressor(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    hidden = Param(Params._dummy(), "hidden", "hidden layer sizes", TypeConverters.toListInt)
    activation = Param(Params._dummy(), "activation", "relu or tanh", TypeConverters.toString)
    alpha = Param(Params._dummy(), "alpha", "L2 penalty", TypeConverters.toFloat)
    learningRate = Param(Params._dummy(), "learningRate", "Adam step", TypeConverters.toFloat)
    maxIter = Param(Params._dummy(), "maxIter", "steps", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "init seed", TypeConverters.toInt)
    featuresCol = Param(Params._dummy(), "featuresCol", "features", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "label", TypeConverters.toString)

    def __init__(self, hidden=(16,), activation="relu", alpha=1e-4, learningRate=1e-2, maxIter=100, seed=42,
                 featuresCol="features", labelCol="label"):
        super().__init__()
        self._set(hidden=list(hidden), activation=activation, alpha=float(alpha), learningRate=float(learningRate),
                  maxIter=int(maxIter), seed=int(seed), featuresCol=featuresCol, labelCol=labelCol)

    def _fit(self, df: DataFrame) -> MLPRegressorModel:
        g = self.getOrDefault
        data = df.select(vector_to_array(g(self.featuresCol)).alias("x"),
                         F.col(g(self.labelCol)).cast("double").alias("y")).persist()
        first = data.first()
        n_in = len(first["x"])
        shapes = _shapes(n_in, g(self.hidden))
        rng = np.random.default_rng(g(self.seed))
        theta = np.concatenate([np.concatenate([rng.normal(0, np.sqrt(2.0 / a), a * b), np.zeros(b)])
                                for a, b in shapes])
        m, v = np.zeros_like(theta), np.zeros_like(theta)
        b1, b2, lr, alpha = 0.9, 0.999, g(self.learningRate), g(self.alpha)
        sc = df.sparkSession.sparkContext
        history = []
        for t in range(1, g(self.maxIter) + 1):
            tb = sc.broadcast(theta)
            parts = data.mapInArrow(_grad_fn(tb, shapes, g(self.activation)),
                                    "g array<double>, loss double, n long").collect()
            tb.unpersist()
            n = sum(p["n"] for p in parts)
            grad = np.sum([np.asarray(p["g"]) for p in parts if p["n"]], axis=0) / max(n, 1) + alpha * theta
            history.append(sum(p["loss"] for p in parts) / max(n, 1))
            m = b1 * m + (1 - b1) * grad
            v = b2 * v + (1 - b2) * grad ** 2
            theta = theta - lr * (m / (1 - b1 ** t)) / (np.sqrt(v / (1 - b2 ** t)) + 1e-8)
        data.unpersist()
        return MLPRegressorModel(theta.tolist(), n_in, g(self.hidden), g(self.activation), history,
                                 g(self.featuresCol))


class MLPRegressorModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    state = Param(Params._dummy(), "state", "weights as JSON", TypeConverters.toString)
    featuresCol = Param(Params._dummy(), "featuresCol", "features", TypeConverters.toString)

    def __init__(self, theta=None, n_in=0, hidden=(), activation="relu", history=(), featuresCol="features"):
        super().__init__()
        self._setDefault(state="{}", featuresCol="features")
        if theta is not None:
            self._set(state=json.dumps({"theta": theta, "n_in": n_in, "hidden": list(hidden),
                                        "activation": activation, "history": list(history)}),
                      featuresCol=featuresCol)

    @property
    def history(self) -> list[float]:
        return json.loads(self.getOrDefault(self.state))["history"]

    def _transform(self, df: DataFrame) -> DataFrame:
        st = json.loads(self.getOrDefault(self.state))
        layers = _unflatten(np.asarray(st["theta"]), _shapes(st["n_in"], st["hidden"]))
        x = vector_to_array(self.getOrDefault(self.featuresCol))
        inputs: list[Column] = [x[i] for i in range(st["n_in"])]
        for li, (w, b) in enumerate(layers):
            outs = []
            for j in range(w.shape[1]):
                z = F.lit(float(b[j]))
                for i in range(w.shape[0]):
                    z = z + inputs[i] * F.lit(float(w[i, j]))
                if li < len(layers) - 1:
                    z = F.greatest(z, F.lit(0.0)) if st["activation"] == "relu" else F.tanh(z)
                outs.append(z)
            # materialise each layer once so the next one does not re-expand it
            arr = F.array(*outs)
            df = df.withColumn(f"__h{li}", arr)
            inputs = [F.col(f"__h{li}")[j] for j in range(len(outs))]
        return df.withColumn("prediction", inputs[0]).drop(*[f"__h{i}" for i in range(len(layers))])
