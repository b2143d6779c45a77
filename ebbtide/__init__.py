"""ebbtide: user-retention features, labels and datasets as Spark DataFrames."""

from ebbtide.config import SplitConfig, WindowConfig

__all__ = ["SplitConfig", "WindowConfig"]
