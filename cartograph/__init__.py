"""cartograph: behaviour-log analytics on Spark DataFrames.

Four batch analyses over an e-commerce behaviour log of
``(user_id, item_id, category_id, behavior_type, ts)`` rows:

* per-user recency / activity / value features scaled to [0, 1]
  (:mod:`cartograph.operators.features`),
* item co-occurrence: inverted index and users-per-item-pair counts
  (:mod:`cartograph.operators.cooccur`),
* k-means over the scaled features (:mod:`cartograph.operators.cluster`),
* personalised rank (random walk with restart) on the user-item graph
  (:mod:`cartograph.operators.rank`).

Every operator takes and returns DataFrames; iteration loops keep only
scalars and the K cluster centres on the driver.
"""

__version__ = "0.1.0"
