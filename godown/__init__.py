"""godown - a Spark-native supply-chain analytics library.

Raw feeds -> Bronze (lineage) -> Silver (typed, deduplicated, imputed,
quality-checked, type-2 history) -> Gold KPI tables -> dashboard data
sets, every step a lazy DataFrame plan.
"""

__version__ = "0.1.0"
