"""docketry.operators"""
