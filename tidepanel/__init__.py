"""tidepanel — entity × period panel analytics on Spark DataFrames.

Every operator is a ``DataFrame -> DataFrame`` function (usable with
``df.transform``) built from built-in Spark expressions, so Catalyst can
prune, push down and codegen the whole chain.
"""

from tidepanel.session import get_spark, scratch_dir
from tidepanel.spec import PanelKey, SchemaSpec

__all__ = ["get_spark", "scratch_dir", "PanelKey", "SchemaSpec"]
