"""docketry.streaming"""
