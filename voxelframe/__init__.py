"""voxelframe: image-volume analytics and registration on Spark DataFrames.

Volumes are rows ``(dataset, z, y, x, v)``; every operator takes and returns
DataFrames and keeps the ``dataset`` key, so many volumes run in one plan.
"""

import sys

from pyspark import cloudpickle

# Arrow kernels defined in this package travel to the executors with the plan,
# so a cluster needs no separate install of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
