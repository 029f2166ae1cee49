"""What an application needs besides DataFrames: this package on the executors, and its Java classes."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from functools import partial
from pathlib import Path

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, SparkSession
from pyspark.sql.classic.column import Column as ClassicColumn
from pyspark.sql.types import DataType

_SHIPPED: set[str] = set()
_LOADERS: dict[tuple[str, Path], JavaObject] = {}
#: Rows and bytes of an Arrow batch where the session has Spark's defaults: texts may be long, and a worker holds
#: a batch several times over.
BATCH_ROWS, BATCH_BYTES = 2000, 16 << 20
DEFAULT_ROWS = "10000"


def ship(spark: SparkSession) -> None:
    """Give this package to the executors, once per application, and keep Arrow batches small."""
    sc = spark.sparkContext
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == DEFAULT_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    if sc.applicationId in _SHIPPED:
        return
    top = Path(__file__).resolve().parent
    out = os.path.join(tempfile.mkdtemp(), f"{top.name}_src.zip")
    with zipfile.ZipFile(out, "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)


def _array(spark: SparkSession, of: JavaObject, items: list) -> JavaObject:
    out = spark.sparkContext._gateway.new_array(of, len(items))
    for i, item in enumerate(items):
        out[i] = item
    return out


def trim(spark: SparkSession) -> bool:
    """Give native memory that the driver's JVM has freed back to the system, in a few ms: its compilers, codecs and sockets
    leave some 200 MB in the pools of their threads. False where the JVM can't (it takes Linux and Java 17.0.9)."""
    jvm = spark.sparkContext._jvm
    array, named = partial(_array, spark), jvm.java.lang.Class.forName
    try:
        # by reflection, as the server's own class isn't open
        kinds = [named(x) for x in ("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")]
        invoke = named("javax.management.MBeanServer").getMethod("invoke", array(jvm.java.lang.Class, kinds))
        what = [jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap", array(jvm.java.lang.Object, []), array(jvm.java.lang.String, [])]
        invoke.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), array(jvm.java.lang.Object, what))
    except Py4JJavaError:
        return False
    return True


def java_function(spark: SparkSession, source: Path, name: str, result: DataType) -> Callable[..., Column]:
    """A class of a Java source file that implements UDF1, UDF2 ..., as a function of columns. Spark's own compiler of
    generated code compiles the file, once per application; executors get the classes as a jar."""
    sc, key = spark.sparkContext, (spark.sparkContext.applicationId, source)
    jvm, array = sc._jvm, partial(_array, spark)
    classes, objects = jvm.java.lang.Class, jvm.java.lang.Object
    if key not in _LOADERS:
        compiler = jvm.org.codehaus.janino.SimpleCompiler()
        compiler.setParentClassLoader(jvm.org.apache.spark.util.Utils.getContextOrSparkClassLoader())
        compiler.cook(source.read_text())
        out = os.path.join(tempfile.mkdtemp(), f"{source.stem}.jar")
        with zipfile.ZipFile(out, "w") as z:
            for own, code in dict(compiler.getBytecodes()).items():
                z.writestr(f"{own.replace('.', '/')}.class", bytes(code))
        sc._jsc.addJar(out)
        _LOADERS[key] = compiler.getClassLoader()
    kind = _LOADERS[key].loadClass(name)
    one = kind.getConstructor(array(classes, [])).newInstance(array(objects, []))
    # by reflection, as udf() has a form for any object as well
    make = classes.forName("org.apache.spark.sql.functions").getMethod("udf", array(classes, [kind.getInterfaces()[0], classes.forName("org.apache.spark.sql.types.DataType")]))
    udf = make.invoke(None, array(objects, [one, spark._jsparkSession.parseDataType(result.json())]))
    return lambda *columns: ClassicColumn(udf.apply(array(jvm.org.apache.spark.sql.Column, [c._jc for c in columns])))
