"""corvid: data jobs as Spark plans.

Quantity grammars, settings rendering and resolution, placement ranking,
documents and ELT steps, expressed with the DataFrame API and built-in
expressions only. See README.md for the inventory.
"""

__version__ = "0.1.0"
