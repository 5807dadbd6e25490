"""Make the package importable by Python workers.

Pandas UDFs and ``mapInPandas`` functions are pickled by reference to this
package, so every executor's Python worker must be able to import it.

On a cluster the package is shipped the standard way, with the job
(``spark-submit --py-files cohortium.zip`` or an installed wheel), and
nothing is written to a machine-local folder. Only in local mode (one
machine, workers started from the driver's environment) does
:func:`ship_package` zip the package once per SparkContext and add it with
``addPyFile``.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_PKG_DIR = os.path.dirname(os.path.abspath(__file__))
_shipped: set[str] = set()


def _zip_package() -> str:
    out = os.path.join(tempfile.mkdtemp(prefix="cohortium-pyfiles-"), "cohortium.zip")
    root = os.path.dirname(_PKG_DIR)
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for base, dirs, files in os.walk(_PKG_DIR):
            dirs[:] = [d for d in dirs if d != "__pycache__"]
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, root))
    return out


def ship_package(spark: SparkSession) -> None:
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _shipped:
        return
    submitted = ",".join(sc.getConf().get(k, "") for k in ("spark.submit.pyFiles", "spark.files"))
    if sc.master.startswith("local") and "cohortium" not in submitted:
        sc.addPyFile(_zip_package())
    _shipped.add(key)
