"""ratingspark: Spark-native rating analytics and recommendation.

Stages and their modules:

* prepare  - ``operators.prep`` (cleaning, dense codes, lookup, baselines),
             ``operators.folds`` (seeded exact folds, splits, counts)
* learn    - ``operators.als`` (pyspark.ml ALS workflow),
             ``operators.gradient`` (full-batch gradient descent on DataFrames),
             ``operators.evaluate`` / ``operators.tune`` (errors, CV, grids)
* explore  - ``operators.vectors`` / ``operators.similar`` (probes, nearest
             items and categories, top items), ``operators.project`` (PCA)
* I/O      - ``sources.files``; session helpers in ``session``.
"""

from . import defaults, session
from .operators import als, evaluate, folds, gradient, indexing, prep, project, similar, tune
from .operators import vectors
from .sources import files

__all__ = ["als", "defaults", "evaluate", "files", "folds", "gradient", "indexing", "prep",
           "project", "session", "similar", "tune", "vectors"]
