"""The range coder as SQL functions: the executors' JVMs run it, compiled from its Java source."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

_SOURCE = os.path.join(os.path.dirname(__file__), "range_coder.java")
_NAMES = {"tessera_encode_block": "tessera.RangeCoder$Encode", "tessera_decode_block": "tessera.RangeCoder$Decode"}


def register(spark: SparkSession) -> None:
    """Registers both functions in this session, once. Spark's own compiler of generated code (Janino)
    makes the classes on the driver; the executors fetch them from the driver as a jar."""
    held = {f.name for name in _NAMES for f in spark.catalog.listFunctions(pattern=name)}
    if held >= _NAMES.keys():
        return
    jvm = spark._jvm
    compiler = jvm.org.codehaus.janino.SimpleCompiler()
    compiler.setParentClassLoader(jvm.java.lang.Thread.currentThread().getContextClassLoader())
    with open(_SOURCE) as f:
        compiler.cook(f.read())
    handle, jar = tempfile.mkstemp(prefix="tessera-coder-", suffix=".jar")
    with os.fdopen(handle, "wb") as f, zipfile.ZipFile(f, "w") as z:
        for name, code in compiler.getBytecodes().items():
            z.writestr(name.replace(".", "/") + ".class", bytes(code))
    spark.sql(f"ADD JAR '{jar}'")
    for name, of in _NAMES.items():  # the class file names no types, which registerJavaFunction asks for
        function = compiler.getClassLoader().loadClass(of).newInstance()
        spark._jsparkSession.udf().register(name, function, jvm.org.apache.spark.sql.types.DataTypes.BinaryType)


def encoded(ids: Column) -> Column:
    """The coded block of ids (little-endian unsigned 32-bit integers)."""
    return F.call_function("tessera_encode_block", ids)


def decoded(block: Column) -> Column:
    """The ids of a coded block, as `encoded` takes them; a damaged one fails the query."""
    return F.call_function("tessera_decode_block", block)
