"""convaudit: Spark-native auditing of customer-service conversations.

Subpackages
-----------
sources    readers, fixture views over the test tables, partitioned sinks
functions  Column-level helpers (tokenise, clean, lexicon predicates, JSON shapes)
operators  DataFrame -> DataFrame building blocks (parse, select, flow, evaluate)
ml         Spark ML feature views, classifiers, model registry
plans      whole jobs: chat audit, speech audit, flow check, daily audit, training
streaming  the stateless audit plans run incrementally over a file stream
"""

from convaudit.config import AuditConfig, FlowConfig  # noqa: F401

__version__ = "0.1.0"
