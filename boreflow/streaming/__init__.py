from .refresh import GoldRefresh, land_silver, latest_dates, refresh_history

__all__ = ["GoldRefresh", "land_silver", "latest_dates", "refresh_history"]
