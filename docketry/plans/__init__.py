"""docketry.plans"""
