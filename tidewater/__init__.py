"""tidewater: traffic analytics and tabular ML as Spark DataFrame operators.

Every public function takes and returns DataFrames (or MLlib models) and
stays lazy; nothing data-sized is collected to the driver.
"""

__version__ = "0.1.0"
