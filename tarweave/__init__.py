"""Image-caption dataset preparation as Spark jobs."""

from tarweave.session import ship_package, work_dir

__all__ = ["ship_package", "work_dir"]
