from .refresh import FIRES, WEATHER, Feed, apply_batch, start_fire_refresh, start_refresh, start_weather_refresh

__all__ = ["FIRES", "WEATHER", "Feed", "apply_batch", "start_fire_refresh", "start_refresh", "start_weather_refresh"]
