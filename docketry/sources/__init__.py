"""docketry.sources"""
