"""Voting over several fitted models, scored side by side without a join."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden.common import kept, written
from logwarden.detectors.base import RAW, Detector, Model, check_contamination
from logwarden.operators.buckets import add_bucket
from logwarden.operators.quantiles import contamination_cut, ranked_values

RANK_POINTS = 100
NORMALISE = ("none", "zscore", "rank")


def mean_of(columns: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns) / F.lit(float(len(columns)))


def soft_vote(scores: Sequence[str]) -> Column:
    return mean_of([F.col(c) for c in scores])


def hard_vote(flags: Sequence[str]) -> Column:
    """1 where more than half of the members flag the row; a tie is normal."""
    return (mean_of([F.col(c) for c in flags]) > 0.5).cast("int")


class EnsembleModel(Model):
    method = "ensemble"

    def __init__(self, members: Sequence[Model], voting: str = "soft", normalise: str = "none",
                 references: Sequence = (), cut: float | None = None, threshold_on: str = "fit",
                 contamination: float = 0.1):
        super().__init__(sorted({c for m in members for c in m.features}), cut)
        self.members, self.voting, self.normalise = list(members), voting, normalise
        self.references, self.threshold_on, self.contamination = list(references), threshold_on, contamination

    def _with_members(self, df: DataFrame, on_null: str) -> DataFrame:
        for i, member in enumerate(self.members):
            df = member.score(df, f"_s{i}", f"_f{i}", on_null)
        return df

    def _normalised(self, df: DataFrame) -> DataFrame:
        if self.normalise == "zscore":
            return df.withColumns({f"_s{i}": (F.col(f"_s{i}") - F.lit(m)) / F.lit(s if s > 0 else 1.0)
                                   for i, (m, s) in enumerate(self.references)})
        if self.normalise == "rank":
            for i, grid in enumerate(self.references):
                # The share of the reference points that lie at or below a score, ties counted as often as they occur.
                edges = sorted(set(grid))
                shares = [0.0, *[sum(g <= e for g in grid) / len(grid) for e in edges]]
                df = add_bucket(df, f"_s{i}", edges, f"_r{i}").withColumn(
                    f"_s{i}", F.get(F.array(*map(F.lit, shares)), F.col(f"_r{i}"))).drop(f"_r{i}")
        return df

    def _drop_members(self, df: DataFrame) -> DataFrame:
        return df.drop(*[f"_{k}{i}" for k in "sf" for i in range(len(self.members))])

    def with_raw(self, df: DataFrame, out: str = RAW, on_null: str = "error") -> DataFrame:
        wide = self._normalised(self._with_members(df, on_null))
        return self._drop_members(wide.withColumn(out, soft_vote([f"_s{i}" for i in range(len(self.members))])))

    def score(self, df: DataFrame, score: str = "score", pred: str = "pred", on_null: str = "error") -> DataFrame:
        if on_null == "drop":
            df = df.na.drop(subset=list(self.features))
        wide = self._normalised(self._with_members(df, on_null))
        wide = wide.withColumn(score, soft_vote([f"_s{i}" for i in range(len(self.members))]))
        if self.voting == "hard":
            flag = hard_vote([f"_f{i}" for i in range(len(self.members))])
        else:
            cut = self.cut
            if self.threshold_on == "batch":
                wide = written(wide, "ensemble")  # the search takes several passes, the members score once
                cut = contamination_cut(wide, score, self.contamination)
            flag = (F.col(score) > F.lit(cut)).cast("int")
        return self._drop_members(wide.withColumn(pred, flag))

    def params(self) -> dict:
        return {**super().params(), "voting": self.voting, "normalise": self.normalise,
                "references": [list(r) for r in self.references], "threshold_on": self.threshold_on,
                "contamination": self.contamination, "members": [m.params() for m in self.members]}

    def arrays(self):
        return {f"{i}/{name}": values for i, m in enumerate(self.members) for name, values in m.arrays().items()}

    @classmethod
    def restore(cls, params, arrays):
        from logwarden.detectors.factory import restore_model

        members = []
        for i, member in enumerate(params["members"]):
            own = {k.split("/", 1)[1]: v for k, v in arrays.items() if k.startswith(f"{i}/")}
            members.append(restore_model(member, own))
        return cls(members, params["voting"], params["normalise"], params["references"], params["cut"],
                   params["threshold_on"], params["contamination"])


class EnsembleDetector(Detector):
    """Fits its members on the same table; the soft cut-off is fitted once and stored.

    ``threshold_on='batch'`` takes it from the rows being scored instead.
    """

    def __init__(self, detectors: Sequence[Detector], voting_method: str = "soft", normalise: str = "none",
                 threshold_on: str = "fit", contamination: float = 0.1):
        check_contamination(contamination)
        if not detectors:
            raise ValueError("an ensemble needs members")
        if voting_method not in ("soft", "hard"):
            raise ValueError("voting_method must be 'soft' or 'hard'")
        if normalise not in NORMALISE or threshold_on not in ("fit", "batch"):
            raise ValueError("unknown normalise or threshold_on")
        super().__init__(contamination=contamination, on_null=detectors[0].on_null)
        self.detectors, self.voting, self.normalise = list(detectors), voting_method, normalise
        self.threshold_on = threshold_on

    def learn(self, df: DataFrame) -> tuple[EnsembleModel, DataFrame]:
        raise NotImplementedError("members learn apart; use fit")

    def fit_score(self, df: DataFrame) -> DataFrame:
        return self.fit(df).score(df, on_null=self.on_null)

    def fit(self, df: DataFrame) -> EnsembleModel:
        members = [d.fit(df) for d in self.detectors]
        model = EnsembleModel(members, self.voting, self.normalise, (), None, self.threshold_on, self.contamination)
        names = [f"_s{i}" for i in range(len(members))]
        # Only the member scores are kept, for the passes of the cut-off search.
        scores = kept(model._with_members(df, self.on_null).select(*names))
        try:
            if self.normalise == "zscore":
                parts = [f(c).alias(f"{k}{c}") for c in names for k, f in (("m", F.avg), ("d", F.stddev_pop))]
                row = scores.agg(*parts).first()
                model.references = [(row[f"m{c}"], row[f"d{c}"]) for c in names]
            elif self.normalise == "rank":
                # Exact scores at evenly spaced ranks of the table.
                for c in names:
                    n, at = ranked_values(scores, c, lambda n: sorted({i * (n - 1) // RANK_POINTS for i in range(RANK_POINTS + 1)}))
                    model.references.append([at[i * (n - 1) // RANK_POINTS] for i in range(RANK_POINTS + 1)])
            mean = model._normalised(scores).select(soft_vote(names).alias(RAW))
            model.cut = contamination_cut(mean, RAW, self.contamination)
        finally:
            scores.unpersist()
        return model
