"""Java functions of the library, compiled where the driver runs.

Work that is neither SQL nor arrays at a time is Java: :func:`java_function`
compiles the source beside this file with Spark's own compiler (Janino, which
Spark's generated code needs anyway), packs the classes into a jar, and adds
that jar to the session, so that every executor has them.
"""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_ADDED = "titleflow.jvm."


def java_object(spark: SparkSession, name: str):
    """A new object of the class in ``<name>.java``; None where the session has no JVM of its own (Connect)."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote session has no context here
        return None
    jvm, empty = sc._jvm, lambda kind: sc._gateway.new_array(kind, 0)
    if not spark.conf.get(_ADDED + name, None):
        compiler = jvm.org.codehaus.janino.SimpleCompiler()
        compiler.setParentClassLoader(jvm.org.apache.spark.util.Utils.getContextOrSparkClassLoader())
        compiler.cook((Path(__file__).parent / f"{name}.java").read_text())
        jar = f"{tempfile.mkdtemp(prefix='titleflow-jar-')}/titleflow-{name}.jar"
        with zipfile.ZipFile(jar, "w") as z:
            for cls, code in dict(compiler.getBytecodes()).items():
                z.writestr(f"{cls.replace('.', '/')}.class", bytes(code))
        spark.sql(f"ADD JAR '{jar}'")
        spark.conf.set(_ADDED + name, "true")
    cls = jvm.java.lang.Class.forName(f"titleflow.{name}", True, jvm.org.apache.spark.util.Utils.getContextOrSparkClassLoader())
    return cls.getDeclaredConstructor(empty(jvm.java.lang.Class)).newInstance(empty(jvm.java.lang.Object))


def java_function(spark: SparkSession, name: str, returns: str, made=None) -> str | None:
    """The SQL name of the Java function in ``<name>.java`` (or of an object ``made`` of it, in place of the one before)."""
    sql_name = f"titleflow_{name}"
    if made is None:
        if spark.conf.get(_ADDED + sql_name, None):
            return sql_name
        made = java_object(spark, name)
        if made is None:
            return None
        spark.conf.set(_ADDED + sql_name, "true")
    # Janino writes no generic types, which registerJavaFunction would look for.
    returned = spark.sparkContext._jvm.org.apache.spark.sql.types.DataType.fromDDL(returns)
    spark._jsparkSession.udf().register(sql_name, made.function(returned))
    return sql_name
