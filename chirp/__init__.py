"""chirp: Spark-native analytics over short social-media posts.

Every public function takes and returns DataFrames (or Columns); nothing
is collected to the driver on the data path.
"""

__version__ = "0.1.0"
