from barlake.streaming.pickup import pick_up_landed

__all__ = ["pick_up_landed"]
