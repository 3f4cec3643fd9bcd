from .ship import driver_folder, ship
from .tables import read_table, spread

__all__ = ["driver_folder", "read_table", "ship", "spread"]
