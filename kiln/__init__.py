"""kiln: corpus preparation written as Spark DataFrame plans.

Stages (each a ``DataFrame -> DataFrame`` function, no action inside unless
the operator is iterative by definition):

* ``kiln.sources``    read / conform / number / budget / shard / manifest
* ``kiln.operators``  quality filters, reports, dedup, BPE, packing, run log
* ``kiln.streaming``  the same filters and dedup over ``readStream``
* ``kiln.plans``      the registered queries over the test tables and their SQL
"""

from kiln.config import DedupConfig, FilterConfig, PackConfig, TokenizerConfig

__all__ = ["DedupConfig", "FilterConfig", "PackConfig", "TokenizerConfig"]
