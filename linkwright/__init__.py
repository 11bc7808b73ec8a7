"""linkwright: record linkage and corpus preparation as Spark plans."""

import os
import sys

_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _make_importable_on_workers() -> None:
    """Python workers must find this package. Where neither PYTHONPATH nor the
    working directory leads them here, functions are shipped by value."""
    known = [os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if os.path.realpath(_ROOT) in known or os.path.realpath(os.getcwd()) == os.path.realpath(_ROOT):
        return
    os.environ["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, [os.environ.get("PYTHONPATH")])])
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_make_importable_on_workers()
