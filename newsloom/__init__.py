"""newsloom: news-intelligence operators on Spark DataFrames.

Every public operator is either ``Column -> Column`` (``newsloom.functions``)
or ``DataFrame -> DataFrame`` (``newsloom.operators``, ``newsloom.sources``),
so Catalyst plans the whole job and nothing passes through the driver.
"""

__version__ = "0.1.0"
