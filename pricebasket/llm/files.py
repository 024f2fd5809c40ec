"""Binary files in the shared folder, as the other operators use them too."""

from pricebasket.array_files import local_path, map_arrays, mapped, write_arrays, writer

__all__ = ["local_path", "map_arrays", "mapped", "write_arrays", "writer"]
